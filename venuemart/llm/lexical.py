"""Ranked lexical search over a length-stratified index.

Documents with the same normaliser m form a stratum; in the index a term's postings lie by stratum, and within a
stratum by tf. Two numbers then decide a posting's share of a score, m and tf, so the share is computed once per
run of documents with equal tf, not per document. The largest tf of a term in a stratum bounds what the term can
add there; the sum of the bounds over an item's terms bounds the stratum. Strata are visited by falling bound,
until the next bound is below the k-th best score found: nothing left out can enter the list, so lists are exact.

The index is cut into shards of documents, each made where its texts are read, without a shuffle. An item is looked
up in every shard; the lists of the shards are merged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venuemart.llm.common import parts_for, stored, text_of

BEST = 50
#: A shard holds up to so many documents (at most 65,536, numbers of 16 bits) and ends with the document that reaches so many terms.
SHARD, SHARD_TERMS = 4_096, 1_000_000
#: Distinct terms of items that are looked up at once, in one block of items.
BLOCK_TERMS = 200_000
#: Rows of a batch whose terms are cut at once.
ROWS = 256

#: Bytes of terms stay (A-Z in lower case), all others become a blank; bytes of other alphabets are 0x80 and up.
_TO = np.full(256, 32, np.uint8)
_TO[0x80:] = np.arange(0x80, 0x100)
for _run in (b"0123456789", b"abcdefghijklmnopqrstuvwxyz"):
    _TO[list(_run)] = list(_run)
_TO[65:91] = np.arange(97, 123)

POSTINGS = "shard bigint, term string, df int, runs binary, docs binary, ids array<bigint>"


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets, from 0, and the translated bytes of a string array without nulls."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return ends - ends[0], _TO[held[ends[0] : ends[-1]]]


def counts_of(texts: pa.Array) -> np.ndarray:
    """Number of terms of each text."""
    ends, data = _bytes_of(texts)
    term = data != 32
    starts = term.copy()
    starts[1:] &= ~term[:-1]
    # A text's first byte has no neighbour before it.
    borders = ends[:-1][ends[:-1] < len(data)]
    starts[borders] = term[borders]
    return np.diff(np.searchsorted(np.flatnonzero(starts), ends))


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms in order, and the number of the text each is from."""
    ends, data = _bytes_of(texts)
    clean = pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data))
    lists = pc.ascii_split_whitespace(clean)
    flat, of = lists.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(full), of[full.to_numpy(zero_copy_only=False)]


@dataclass
class Index:
    """A stored table of shards, and the two numbers that the normaliser takes from all documents."""

    postings: DataFrame
    documents: int
    terms: int


def _cells(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary cells: rows `ends[i]` to `ends[i + 1]` of an array."""
    width = values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _shard(number: int, words: pa.Array, of: np.ndarray, ids: pa.Array, n_documents: int, n_terms: int):
    """Rows of one shard: one without a term for its documents, and one for each term."""
    d = len(ids)
    length = np.bincount(of, minlength=d)
    m = np.array([50 + 50 * n * n_documents // n_terms for n in length.tolist()], np.int64)
    order = np.argsort(m, kind="stable")
    place = np.empty(d, np.int64)
    place[order] = np.arange(d)
    norms, stratum = np.unique(m[order], return_inverse=True)
    coded = words.dictionary_encode()
    pairs, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * d + place[of], return_counts=True)
    term, doc = pairs // d, pairs % d
    by_tf = np.lexsort((tf, stratum[doc], term))
    term, doc, tf = term[by_tf], doc[by_tf], tf[by_tf]
    level = stratum[doc]
    new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (level[1:] != level[:-1]) | (tf[1:] != tf[:-1])]))
    runs = np.stack([level[new], tf[new], np.diff(np.append(new, len(term)))], axis=1).astype(np.int32)
    run_ends = np.searchsorted(term[new], np.arange(len(coded.dictionary) + 1))
    doc_ends = np.searchsorted(term, np.arange(len(coded.dictionary) + 1))
    names = ["shard", "term", "df", "runs", "docs", "ids"]
    one = [
        pa.array([number], pa.int64()),
        pa.array([None], pa.string()),
        pa.array([d], pa.int32()),
        pa.array([norms.tobytes()], pa.binary()),
        pa.array([stratum.astype(np.int32).tobytes()], pa.binary()),
        pa.ListArray.from_arrays(pa.array([0, d], pa.int32()), ids.take(pa.array(order))),
    ]
    yield pa.RecordBatch.from_arrays(one, names)
    docs, step = doc.astype(np.uint16), 1 << 16
    for start in range(0, len(coded.dictionary), step):
        end = min(start + step, len(coded.dictionary))
        r, p = run_ends[start : end + 1], doc_ends[start : end + 1]
        k = end - start
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(k, number, np.int64)),
                coded.dictionary.slice(start, k),
                pa.array(np.diff(p).astype(np.int32)),
                _cells(runs[r[0] : r[-1]], r - r[0]),
                _cells(docs[p[0] : p[-1]], p - p[0]),
                pa.nulls(k, pa.list_(pa.int64())),
            ],
            names,
        )


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD, shard_terms: int = SHARD_TERMS) -> Index:
    """The index of all documents that have a term. Ids may be null or repeated; each row is a document."""
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))

    def count(batches):
        documents = terms = 0
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                n = counts_of(batch.column("text").slice(start, ROWS))
                documents, terms = documents + int((n > 0).sum()), terms + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([terms])], ["documents", "terms"])

    sums = base.mapInArrow(count, "documents bigint, terms bigint").agg(F.sum("documents"), F.sum("terms")).first()
    n_documents, n_terms = (int(x or 0) for x in sums)

    step = min(ROWS, shard)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        words, of, ids, size, terms = [], [], [], 0, 0

        def done():
            return _shard(number, pa.concat_arrays(words), np.concatenate(of), pa.concat_arrays(ids), n_documents, n_terms)

        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                full = np.flatnonzero(counts_of(part.column("text")))
                if not len(full):
                    continue
                if size and (size + len(full) > shard or terms >= shard_terms):
                    yield from done()
                    words, of, ids, size, terms, number = [], [], [], 0, 0, number + 1
                new, owner = terms_of(part.column("text").take(pa.array(full)))
                words.append(new)
                of.append(owner + size)
                ids.append(part.column("id").take(pa.array(full)))
                size, terms = size + len(full), terms + len(new)
        if size:
            yield from done()

    return Index(stored(base.mapInArrow(run, POSTINGS), "index"), n_documents, n_terms)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds to a score."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Shard:
    """One shard's postings of the asked terms."""

    def __init__(self, rows: pa.Table):
        at = {t: k for k, t in enumerate(rows.column("term").to_pylist())}
        own = at.pop(None)
        runs, docs = rows.column("runs").to_pylist(), rows.column("docs").to_pylist()
        self.norms, self.stratum = np.frombuffer(runs[own], np.int64), np.frombuffer(docs[own], np.int32)
        ids = rows.column("ids")[own].as_py()
        self.known = np.array([i is not None for i in ids])
        self.ids = np.array([i or 0 for i in ids], np.int64)
        self.docs = np.frombuffer(b"".join(docs[k] for k in at.values()), np.uint16)
        self.lists, start = {}, 0
        for term, k in at.items():
            level, tf, size = np.frombuffer(runs[k], np.int32).reshape(-1, 3).T.astype(np.int64)
            ends = start + np.cumsum(size)
            last = np.append(level[1:] != level[:-1], True)
            adds = impact(tf, self.norms[level])
            # The last run of a stratum has its largest tf.
            self.lists[term] = level, adds, ends - size, size, level[last], adds[last]
            start = int(ends[-1])

    def best(self, weights: dict[str, int], k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the k best documents, and the number of strata visited."""
        met = [(w, self.lists[t]) for t, w in weights.items() if w and t in self.lists]
        if not met:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        bound = np.zeros(len(self.norms), np.int64)
        for w, (_, _, _, _, level, adds) in met:
            bound[level] += w * adds
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        level = np.concatenate([x[0] for _, x in met])
        value = np.concatenate([w * x[1] for w, x in met])
        start, size = np.concatenate([x[2] for _, x in met]), np.concatenate([x[3] for _, x in met])
        score = np.zeros(len(self.ids), np.int64)
        least, at, step = 0, 0, 8
        while at < len(order) and bound[order[at]] >= max(least, 1):
            now = np.zeros(len(self.norms), bool)
            now[order[at : at + step]] = True
            at, step = at + step, 2 * step
            asked = np.flatnonzero(now[level])
            many = size[asked]
            places = np.repeat(start[asked] - np.cumsum(many) + many, many) + np.arange(many.sum())
            np.add.at(score, self.docs[places], np.repeat(value[asked], many))
            if np.count_nonzero(score) >= k:
                least = int(np.partition(score, len(score) - k)[len(score) - k])
        found = np.flatnonzero(score >= max(least, 1))
        first = np.lexsort((self.ids[found], self.known[found], -score[found]))[:k]
        return found[first], score[found[first]], min(at, len(order))


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text", best: int = BEST) -> DataFrame:
    """Each item's `best` documents with a score above 0: item id, rank from 1, doc_id, score.

    Every row of items is an item of its own, also with a null or repeated id; null texts, and texts without a
    term, find nothing, and so does an empty table. Equal scores rank by ascending doc_id, null first; documents
    with equal ids are separate. Other columns, whatever their names, are not read. Items are taken in blocks of
    about `BLOCK_TERMS` terms, the only thing that all tasks receive.
    """
    kept = items.select(F.col(id_col).alias("item"), text_of(text_col).alias("text"), F.monotonically_increasing_id().alias("key"))
    kept = stored(kept, "items")

    def cut(batches):
        for batch in batches:
            words, of = terms_of(batch.column("text"))
            pairs = pa.table({"key": batch.column("key").take(pa.array(of)), "term": words}).group_by(["key", "term"]).aggregate([])
            yield from pairs.select(["key", "term"]).combine_chunks().to_batches()

    terms = stored(kept.select("key", "text").mapInArrow(cut, "key bigint, term string"), "terms")
    blocks = parts_for(terms.count(), BLOCK_TERMS)
    found = [_block(index, terms.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b), best) for b in range(blocks)]
    lists = found[0]
    for more in found[1:]:
        lists = lists.union(more)
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    ranked = lists.withColumn("rank", rank).where(F.col("rank") <= best)
    return kept.select("key", "item").join(ranked, "key").select(F.col("item").alias(id_col), "rank", "doc_id", "score")


def _block(index: Index, terms: DataFrame, best: int) -> DataFrame:
    """(key, doc_id, score): for one block of items the best documents of each shard."""
    asked = F.broadcast(terms.select("term").distinct())
    df = index.postings.where("term IS NOT NULL").join(asked, "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * index.documents + 2) / (2 * F.col("df") + 1)))
    weights: dict[int, dict[str, int]] = {}
    for row in terms.join(F.broadcast(df.select("term", weight.alias("w"))), "term").collect():
        weights.setdefault(row.key, {})[row.term] = row.w
    sent = index.postings.sparkSession.sparkContext.broadcast(weights)

    def run(rows: pa.Table) -> pa.Table:
        shard, keys, ids, scores = Shard(rows), [], [], []
        for key, own in sent.value.items():
            place, score, _ = shard.best(own, best)
            keys.append(np.full(len(place), key))
            ids.append(pa.array(shard.ids[place], mask=~shard.known[place]))
            scores.append(score)
        empty = np.zeros(0, np.int64)
        return pa.table({"key": np.concatenate([empty, *keys]), "doc_id": pa.concat_arrays([pa.array(empty), *ids]), "score": np.concatenate([empty, *scores])})

    flagged = index.postings.join(asked.withColumn("asked", F.lit(True)), "term", "left")
    met = flagged.where("asked OR term IS NULL").select("shard", "term", "runs", "docs", "ids")
    return met.groupBy("shard").applyInArrow(run, "key bigint, doc_id bigint, score bigint")


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", best: int = BEST) -> DataFrame:
    """`build` over docs, then `search` for items."""
    return search(build(docs, id_col, text_col), items, item_col, text_col, best)
