"""SimHash near-dedup: a byte-position inverted index over fingerprints, with count filtering.

Fingerprints of 64 bits are eight positional bytes. Two that differ in at most two bits share at least six of
them, the guaranteed minimum. The index is refined in levels, so that no list is paired whole:

1. Postings under four positional bytes: two of the four byte pairs, six lists per fingerprint. Two
   differing bytes spoil at most two byte pairs, so linked fingerprints meet in at least one list.
2. Members of lists longer than `longest` are posted again under six positional bytes, all 28 choices of six
   out of eight: what meets there has reached the guaranteed minimum already.
3. Members of lists that are still too long are posted under those six bytes and each value of the other two
   that is at most one bit away. Such a list holds at most 17 fingerprints, all within two bits of each
   other, and its smallest member links to the rest; linked fingerprints meet in the list of a value between.

In the lists of 1 the members are posted under their other positional bytes too, and the bytes that a pair meets
under are tallied. Pairs that reach six, as all in the lists of 2 do, are verified by the number of differing bits. Every linked pair is found, directly or, on level 3, through members that
both are linked to; the number of postings is in proportion to the number of fingerprints.
"""

from __future__ import annotations

from functools import partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.llm.common import packed, stored, text_of, with_fields
from venuemart.llm.components import components
from venuemart.operators.skew import skew_join

BITS = 2
SHARED = 8 - BITS
#: Lists of up to this many fingerprints are paired.
LONGEST = 32
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str, size: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats included; 0 if there is no word."""
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [words] if len(words) < size else zip(*(words[i:] for i in range(size)), strict=False)
    n = max(1, len(words) - size + 1)
    hashes = np.fromiter(map(_hash, map(b" ".join, grams)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        octets = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """docs (any columns and `text`): the other columns and `fp`."""
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches):
        for batch in batches:
            fps = pa.array([fingerprint(t, size) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in rest], fps], [*[f.name for f in rest], "fp"])

    return docs.mapInArrow(run, with_fields(T.StructType(rest), T.StructField("fp", T.LongType())))


def _octets(fp: Column, positions: tuple[int, ...]) -> Column:
    """The bytes at the positions, side by side in a long."""
    parts = [F.shiftleft(F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)), 8 * i) for i, p in enumerate(positions)]
    return reduce(lambda x, y: x.bitwiseOR(y), parts)


PAIRED = [(2 * i, 2 * i + 1, 2 * j, 2 * j + 1) for i, j in combinations(range(4), 2)]
SIX = list(combinations(range(8), SHARED))


def postings(fps: DataFrame, choices: list[tuple[int, ...]]) -> DataFrame:
    """(key, fp) for each choice of positions; the key holds the choice in its top byte."""
    keys = [_octets(F.col("fp"), c).bitwiseOR(F.lit(k << 56)) for k, c in enumerate(choices)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def tallied(lists: DataFrame, choices: list[tuple[int, ...]], least: int = SHARED) -> DataFrame:
    """Pairs (u, v) of one list that share at least `least` positional bytes.

    Members share the bytes of their list's key. If these are too few, they are posted under each of the other
    positional bytes, and what a pair meets under is counted.
    """
    if all(len(c) >= least for c in choices):
        found = lists.alias("l").join(lists.alias("r"), "key").where("l.fp > r.fp")
        return found.select(F.col("l.fp").alias("u"), F.col("r.fp").alias("v")).distinct()
    other = [[F.lit(p << 8).bitwiseOR(_octets(F.col("fp"), (p,))) for p in range(8) if p not in c] for c in choices]
    choice = F.shiftrightunsigned("key", 56).cast("int")
    posted = lists.select("key", "fp", F.explode(F.get(F.array(*[F.array(*x) for x in other]), choice)).alias("octet"))
    met = posted.alias("l").join(posted.alias("r"), ["key", "octet"]).where("l.fp > r.fp")
    met = met.groupBy("key", F.col("l.fp").alias("u"), F.col("r.fp").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    shared = F.get(F.array(*[F.lit(len(c)) for c in choices]), choice) + F.col("n")
    return met.where(shared >= least).select("u", "v").distinct()


def verified(pairs: DataFrame, bits: int = BITS) -> DataFrame:
    """Pairs whose fingerprints differ in at most `bits` bits."""
    return pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= bits)


def _split(posted: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """Postings in lists of 2 to `longest` members, and the fingerprints in longer lists."""
    sizes = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = stored(skew_join(posted, sizes, ["key"], counts=sizes, place="fp"), "postings")
    return met.where(F.col("n") <= longest).select("key", "fp"), met.where(F.col("n") > longest).select("fp").distinct()


def links(fps: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints at most two bits apart, and no others."""
    short, crowded = _split(postings(fps, PAIRED), longest)
    short6, crowded6 = _split(postings(stored(crowded, "crowded"), SIX), longest)
    near = []
    for k, choice in enumerate(SIX):
        masks = [0, *(1 << (8 * p + b) for p in range(8) if p not in choice for b in range(8))]
        signed = [m - (1 << 64) if m >> 63 else m for m in masks]
        near += [F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseXOR(F.lit(m)).alias("value")) for m in signed]
    # Six bytes and a value of the other two make up one whole fingerprint, named with its choice.
    posted = crowded6.select("fp", F.explode(F.array(*near)).alias("at"))
    stars = posted.groupBy("at").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    stars = stars.select(F.explode("all").alias("u"), F.array_min("all").alias("v")).where("u != v")
    return verified(tallied(short, PAIRED).union(tallied(short6, SIX))).union(stars).distinct()


def near_groups(held: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Per distinct fp of held (id, fp): component_id and `keep`, the fingerprint of the row with that id.

    held must be a stored table.
    """
    fps = stored(held.groupBy("fp").agg(F.min("id").alias("first")), "fingerprints")
    root = components(links(fps.select("fp"), longest)).withColumnRenamed("node", "fp")
    rooted = fps.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stored(rooted, "rooted")
    best = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "fp"))
    firsts = rooted.groupBy("root").agg(best.alias("best"))
    return rooted.join(firsts, "root").select("fp", F.col("best.first").alias("component_id"), F.col("best.fp").alias("keep"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits) and component_id, the smallest id reachable over links.

    Null text counts as empty; its fingerprint is zero and links like any other. Null ids get a component_id
    like other rows but never are one, unless the component holds no other id. Repeated rows are in one
    component. Other columns are not read.
    """
    held = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
    held = stored(with_fingerprints(held), "held")
    out = skew_join(held, near_groups(held, longest), ["fp"])
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST) -> DataFrame:
    """The rows of docs, all columns, of which each component keeps the one with the smallest id.

    Components are those of `simhash_dedup`. Null text counts as empty; rows with a null id stay only if their
    component has no other; of rows alike in id and fingerprint one stays. Other columns, whatever their names,
    come through unread.
    """
    base = packed(docs, id=F.col(id_col).cast("bigint"), text=text_of(text_col))
    marked = with_fingerprints(base)
    held = stored(marked.select("id", "fp"), "held")
    keep = near_groups(held, longest).where(F.col("fp") == F.col("keep")).select(F.col("component_id").alias("first"), F.col("keep"))
    same = F.col("id").eqNullSafe(F.col("first")) & (F.col("fp") == F.col("keep"))
    met = marked.join(keep, same, "left_semi")
    first = F.row_number().over(Window.partitionBy("id", "fp").orderBy("tie"))
    return met.withColumn("tie", F.monotonically_increasing_id()).withColumn("rank", first).where("rank = 1").select("row.*")
