"""SentencePiece unigram encoding and decoding: Viterbi over a double-array trie of scored pieces.

Blanks become the marker U+2581, and one is put before the text. The best path maximises the sum of the pieces'
log scores; a character that no piece covers costs the lowest score less ten and is written as its bytes, or as
the unknown piece where the vocabulary has none. Decoding joins the pieces, turns markers into blanks and byte
pieces into characters, and takes the first blank away.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.llm.common import packed, slices, text_of, with_fields

MARK = "▁"
#: Characters of the segments that are searched many at a time; longer ones are searched one by one.
SHORT = 24
UNKNOWN_COST = 10.0
#: Segments whose ids a Python worker remembers.
REMEMBERED = 400_000


class DoubleArray:
    """A trie over byte strings in two arrays: the child of s by byte c is t = base[s] + c + 1 if check[t] = s.

    The child by 0 ends a key; its base holds the key's value as -1 - value.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        self.base, self.check = [0], [-1]
        used = bytearray(b"\x01")
        pairs = sorted(zip(keys, values, strict=True))
        todo, free = [(0, 0, len(pairs), 0)], 1
        while todo:
            state, low, high, depth = todo.pop()
            children, at = [], low
            while at < high:
                key = pairs[at][0]
                code = key[depth] + 1 if len(key) > depth else 0
                end = at + 1
                while end < high and (pairs[end][0][depth] + 1 if len(pairs[end][0]) > depth else 0) == code:
                    end += 1
                children.append((code, at, end))
                at = end
            while free < len(used) and used[free]:
                free += 1
            place = max(1, free - children[0][0])
            while any(place + c < len(used) and used[place + c] for c, _, _ in children):
                place += 1
            grow = place + 257 - len(used)
            if grow > 0:
                used.extend(bytes(grow))
                self.base.extend([0] * grow)
                self.check.extend([-1] * grow)
            self.base[state] = place
            for code, first, last in children:
                used[place + code] = 1
                self.check[place + code] = state
                if code:
                    todo.append((place + code, first, last, depth + 1))
                else:
                    self.base[place] = -1 - pairs[first][1]

    def prefixes(self, data: bytes, start: int) -> list[tuple[int, int]]:
        """(end, value) of all keys that start at the position, shortest first."""
        base, check, state, out = self.base, self.check, 0, []
        for at in range(start, len(data)):
            to = base[state] + data[at] + 1
            if check[to] != state:
                break
            state = to
            end = base[state]
            if check[end] == state and base[end] < 0:
                out.append((at + 1, -1 - base[end]))
        return out


class Vocabulary:
    """pieces: (text, score, kind) by id, kind one of normal, unknown, control, byte, unused."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        normal = [k for k, p in enumerate(pieces) if p[2] == "normal"]
        self.trie = DoubleArray([pieces[k][0].encode() for k in normal], normal)
        self.scores = [p[1] for p in pieces]
        self.least = min((pieces[k][1] for k in normal), default=0.0) - UNKNOWN_COST
        self.unknown = next((k for k, p in enumerate(pieces) if p[2] == "unknown"), 0)
        self.bytes = {int(p[0][3:5], 16): k for k, p in enumerate(pieces) if p[2] == "byte"}
        self.whole = {"normal": lambda p: p.replace(MARK, " ").encode(), "byte": lambda p: bytes([int(p[3:5], 16)]), "unknown": lambda p: b" \xe2\x81\x87 "}
        self.raw = [self.whole[p[2]](p[0]) if p[2] in self.whole else b"" for p in pieces]
        del self.whole
        texts = [pieces[k][0] for k in normal]
        # No piece goes on over a marker or a line feed, so the best path never does either.
        self.splits = all(MARK not in t.lstrip(MARK) for t in texts)
        self.lines = self.splits and not any("\n" in t for t in texts) and len(self.bytes) == 256
        self.joined = {t[k - 1 : k + 1] for t in texts for k in range(1, len(t))}
        self.cuts = len(self.bytes) == 256
        self.arrays = np.array(self.trie.base, np.int32), np.array(self.trie.check, np.int32), np.array(self.scores)
        self.known: dict[str, tuple[int, ...]] = {}

    def segment(self, text: str) -> tuple[int, ...]:
        """The ids of the best path; of equal ones the path whose last pieces are longer."""
        data = text.encode()
        n = len(data)
        best, back, how = [None] * (n + 1), [0] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        scores, base, check = self.scores, self.trie.base, self.trie.check
        for at in range(n):
            here = best[at]
            if here is None:
                continue
            lead = data[at]
            step = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            single, state, end = False, 0, at
            # Walks the trie over all pieces that start here, shortest first.
            while end < n:
                to = base[state] + data[end] + 1
                if check[to] != state:
                    break
                state, end = to, end + 1
                leaf = base[state]
                if check[leaf] == state:
                    piece = -1 - base[leaf]
                    total = here + scores[piece]
                    if best[end] is None or total > best[end]:
                        best[end], back[end], how[end] = total, at, piece
                    if end == step:
                        single = True
            if not single:
                total = here + self.least
                if best[step] is None or total > best[step]:
                    best[step], back[step], how[step] = total, at, None
        out, end = [], n
        while end:
            at, piece = back[end], how[end]
            if piece is not None:
                out.append(piece)
            elif len(self.bytes) == 256:
                out.extend(self.bytes[b] for b in reversed(data[at:end]))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
            end = at
        return tuple(reversed(out))

    def _segments(self, texts: list[str]) -> list[tuple[int, ...]]:
        """The same for many short texts at once.

        Bytes lie by position, then text. The trie is walked from all characters of all texts together, a step a
        byte; the best paths then grow position by position, and are read back in step.
        """
        base, check, scores = self.arrays
        raw = [t.encode() for t in texts]
        many, size = len(raw), np.array([len(r) for r in raw])
        width = int(size.max())
        by_text = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw), np.uint8).reshape(many, width)
        data = np.ascontiguousarray(by_text.T).reshape(-1).astype(np.int32)
        inside = (np.arange(width)[:, None] < size).reshape(-1)
        start = np.flatnonzero(inside & ((data & 0xC0) != 0x80))
        lead = data[start]
        step = (1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)).astype(np.int64)
        single = np.zeros(len(start), bool)
        froms, ends, pieces, lengths = [], [], [], []
        who, state, at, depth = np.arange(len(start)), np.zeros(len(start), np.int32), start, 0
        while len(who):
            to = base[state] + data[at] + 1
            good = check[to] == state
            who, state, at, depth = who[good], to[good], at[good] + many, depth + 1
            leaf = base[state]
            full = np.flatnonzero(check[leaf] == state)
            found = who[full]
            froms.append(start[found])
            ends.append(at[full])
            pieces.append(-1 - base[leaf[full]])
            lengths.append(np.full(len(full), depth))
            single[found[step[found] == depth]] = True
            going = at < len(data)
            going[going] = inside[at[going]]
            who, state, at = who[going], state[going], at[going]
        lone = np.flatnonzero(~single)
        froms, ends = np.concatenate([*froms, start[lone]]), np.concatenate([*ends, start[lone] + many * step[lone]])
        pieces, lengths = np.concatenate([*pieces, np.full(len(lone), -1)]), np.concatenate([*lengths, step[lone]])
        # By end, and of one end the longest first: it stays where totals are equal.
        order = np.argsort(ends * 512 + (511 - lengths))
        froms, ends, pieces = froms[order], ends[order], pieces[order]
        adds = np.where(pieces >= 0, scores[pieces], self.least)
        best, back, how = np.zeros((width + 1) * many), np.zeros((width + 1) * many, np.int64), np.zeros((width + 1) * many, np.int64)
        borders = np.searchsorted(ends, np.arange(1, width + 2) * many)
        for low, high in zip(borders[:-1], borders[1:], strict=True):
            if low == high:
                continue
            total, end = best[froms[low:high]] + adds[low:high], ends[low:high]
            new = np.append(True, end[1:] != end[:-1])
            heads = np.flatnonzero(new)
            most = np.maximum.reduceat(total, heads)
            group = np.cumsum(new) - 1
            hits = np.flatnonzero(total == most[group])
            hits = hits[np.append(True, group[hits[1:]] != group[hits[:-1]])]
            at = end[heads]
            best[at], back[at], how[at] = most, froms[low:high][hits], pieces[low:high][hits]
        path, at = [], size * many + np.arange(many)
        while (at >= many).any():
            going = at >= many
            path.append(np.where(going, how[at], -2))
            at = np.where(going, back[at], at)
        ids = np.stack(path[::-1], axis=1)
        kept = ids != -2
        flat, cuts = ids[kept].tolist(), np.cumsum(np.append(0, kept.sum(axis=1))).tolist()
        out = [tuple(flat[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for k in np.flatnonzero((ids == -1).any(axis=1)).tolist():
            out[k] = self.segment(texts[k])
        return out

    def prepare(self, texts: list[str]) -> None:
        """Remember the segments of these texts, found many at a time. It changes no result, only the time."""
        if not (self.lines and self.cuts):
            return
        need = set()
        for text in texts:
            for line in (MARK + text.replace(" ", " " + MARK)).split("\n"):
                need.update(line.split(" "))
        need = {w for w in need if w and w not in self.known}
        if len(self.known) + len(need) > REMEMBERED:
            self.known.clear()
        new = sorted((w for w in need if len(w) <= SHORT), key=len)
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            self.known.update(zip(part, self._segments(part), strict=True))

    def _parts(self, text: str) -> list[str]:
        """The text cut wherever no piece holds both neighbours; no best path crosses such a place."""
        if not self.cuts:
            return [text]
        joined = self.joined
        ends = [k for k in range(1, len(text)) if text[k - 1 : k + 1] not in joined]
        return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True)] if ends else [text]

    def _remembered(self, text: str) -> tuple[int, ...]:
        got = self.known.get(text)
        if got is None:
            parts = self._parts(text)
            # The parts come again with other neighbours.
            got = self.segment(text) if len(parts) == 1 else tuple(chain.from_iterable(map(self._remembered, parts)))
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = got
        return got

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        if not self.splits:
            return list(self.segment(MARK + text.replace(" ", MARK)))
        if self.lines and MARK not in text and "  " not in text and " \n" not in text and text[0] != " " and text[-1] != " ":
            return self._single_blanks(text)
        feed = self.bytes.get(10)
        for k, line in enumerate((MARK + text.replace(" ", MARK)).split("\n") if self.lines else [MARK + text.replace(" ", MARK)]):
            if k:
                out.append(feed)
            words = line.split(MARK)
            if words[0]:
                out.extend(self._remembered(words[0]))
            # Runs of markers belong to the word after them.
            run = 0
            for w in words[1:]:
                run += 1
                if w:
                    out.extend(self._remembered(MARK * run + w))
                    run = 0
            if run:
                out.extend(self._remembered(MARK * run))
        return out

    def _single_blanks(self, text: str) -> list[int]:
        """Where no two markers meet, each word has its own."""
        out: list[int] = []
        held, feed = self.known.__getitem__, self.bytes[10]
        for k, line in enumerate((MARK + text.replace(" ", " " + MARK)).split("\n")):
            if k:
                out.append(feed)
            words = line.split(" ")
            if not words[0]:
                del words[0]
            try:
                out.extend(chain.from_iterable([*map(held, words)]))
            except KeyError:
                for w in words:
                    out.extend(self._remembered(w))
        return out

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _lists(rows: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def load(model_file: str) -> Vocabulary:
    """Read the pieces of a .model file, on the driver."""
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=model_file)

    def kind(k: int) -> str:
        return "unknown" if held.is_unknown(k) else "control" if held.is_control(k) else "byte" if held.is_byte(k) else "unused" if held.is_unused(k) else "normal"

    return Vocabulary([(held.id_to_piece(k), held.get_score(k), kind(k)) for k in range(held.get_piece_size())])


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """Rows of docs as struct `row`, with `ids`. Null text counts as empty, which has no ids."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    base = packed(docs, text=text_of(text_col))

    def run(batches):
        own = sent.value
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            own.prepare(texts)
            ids = _lists([own.encode(t) for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column("row"), ids], ["row", "ids"])

    return base.mapInArrow(run, with_fields(T.StructType([base.schema["row"]]), T.StructField("ids", T.ArrayType(T.IntegerType()))))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """Rows of encoded, all columns, as struct `row`, with `decoded`. Null ids give an empty text.

    Texts come back as they were, except that a marker character of the text itself becomes a blank.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    base = packed(encoded, ids=F.coalesce(F.col(ids_col), F.array().cast("array<int>")))

    def run(batches):
        own = sent.value
        for batch in slices(batches):
            ids = batch.column("ids")
            flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *pa.compute.list_value_length(ids).to_pylist()])
            out = [own.decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "decoded"])

    return base.mapInArrow(run, with_fields(T.StructType([base.schema["row"]]), T.StructField("decoded", T.StringType())))


def encode_and_decode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids, n_ids, decoded_sha256 (of the decoded text), exact (whether that is the text).

    Both directions in one pass, so neither the text nor the ids go through a second Python worker. Null text
    counts as empty; null ids and repeated rows are ordinary rows. Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))

    def run(batches):
        own = sent.value
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            own.prepare(texts)
            ids = [own.encode(t) for t in texts]
            decoded = [own.decode(x) for x in ids]
            marks = [hashlib.sha256(t.encode()).hexdigest() for t in decoded]
            same = [a == b for a, b in zip(texts, decoded, strict=True)]
            columns = [batch.column("id"), _lists(ids), pa.array([len(x) for x in ids], pa.int64()), pa.array(marks, pa.string()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "n_ids", "decoded_sha256", "exact"])

    return base.mapInArrow(run, "id bigint, ids array<int>, n_ids bigint, decoded_sha256 string, exact boolean").withColumnRenamed("id", id_col)
