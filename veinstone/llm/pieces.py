"""SentencePiece encoding by Unigram Viterbi over a double-array trie, and decoding.

The pieces and their log scores come from a model file whose path is a parameter; nothing is
trained. A BPE model holds merge ranks in place of log scores; Zipf's law makes them some: the
piece of rank r gets the log of 1 / (r + 1), less that of the sum over all ranks. A text gets a
leading blank, blanks become the marker U+2581, and of all ways to spell it with pieces that with
the largest sum of scores wins (ties: the longer last piece). A character that no piece spells alone costs the smallest score less 10 and is written as its
UTF-8 bytes. A marker that stands in the text itself is written as bytes too, so decoding gives
every text back exactly.

No piece reaches over the end of a word into a marker, so a text's best path is that of its
words one after another. Each Arrow chunk is cut into words by Arrow kernels, its distinct words
are decoded together (one numpy step per byte and trie depth for all words of like length) and
the ids are gathered by word. Long words, such as texts of scripts without blanks, are first cut
wherever no piece reaches over. Where a vocabulary has pieces that do reach over markers, whole texts
are taken as words. Tables are of the vocabulary's size and broadcast; chunks bound the memory.

Defined results: null and empty texts have no ids; what is long and cannot be cut takes a scalar path
of the same result; repeated rows are encoded each on their own; an empty table gives an empty result; key
and text are read, no other column, whatever it is called.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinstone.llm.common import chunks, texts_of

MARK = "▁"
MARK_BYTES = MARK.encode()
UNKNOWN_PENALTY = 10.0
#: Words of more bytes are cut, and decoded one by one if they are still longer.
LONG = 96
CUT = "\x1f"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def wire(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message; nested messages as bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        elif tag & 7 == 2:
            n, at = varint(at)
            value, at = data[at : at + n], at + n
        else:
            n = {1: 8, 5: 4}[tag & 7]
            value, at = data[at : at + n], at + n
        yield tag >> 3, value


def read_pieces(model: bytes) -> list[tuple[str, float, int]]:
    """(piece, log score, kind) by id."""
    out, bpe = [], False
    for field, value in wire(model):
        if field == 1:
            parts = dict(wire(value))
            out.append((parts.get(1, b"").decode(), struct.unpack("<f", parts.get(2, b"\0\0\0\0"))[0], parts.get(3, NORMAL)))
        elif field == 2:
            bpe = dict(wire(value)).get(3, 1) == 2
    if bpe:
        ranked = [i for i, (_, _, kind) in enumerate(out) if kind in (NORMAL, USER)]
        total = np.log(sum(1 / (r + 1) for r in range(len(ranked))))
        for r, i in enumerate(ranked):
            out[i] = (out[i][0], float(-np.log(r + 1) - total), out[i][2])
    return out


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of a trie: the child of s by byte b is base[s] + b if check there is s; value is the key's id or -1."""
    tree: dict = {}
    for key, i in keys.items():
        node = tree
        for b in key:
            node = node.setdefault(b, {})
        node[256] = i
    size = 4096
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    free, used_to = np.ones(size, bool), 1
    free[0] = False
    queue = [(tree, 0)]
    while queue:
        later = []
        for node, s in queue:
            value[s] = node.get(256, -1)
            bytes_ = np.array(sorted(b for b in node if b < 256))
            if not len(bytes_):
                continue
            while True:
                starts = np.arange(max(1, used_to - bytes_[0]), len(free) - 256)
                fit = free[starts + bytes_[0]]
                for b in bytes_[1:]:
                    fit &= free[starts + b]
                hit = int(np.argmax(fit)) if len(fit) and fit.any() else -1
                if hit >= 0:
                    at = int(starts[hit])
                    break
                base, check, value = (np.concatenate([x, np.full(len(x), f, np.int32)]) for x, f in ((base, 0), (check, -1), (value, -1)))
                free = np.concatenate([free, np.ones(len(free), bool)])
            base[s] = at
            for b in bytes_:
                check[at + b], free[at + b] = s, False
                later.append((node[int(b)], at + int(b)))
            while used_to < len(free) and not free[used_to]:
                used_to += 1
            if len(bytes_) == 1 and at + bytes_[0] > used_to + 65536:  # leave small holes behind
                used_to += 256
        queue = later
    return base, check, value


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[tuple[str, float, int], ...]
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    score: np.ndarray
    byte_id: np.ndarray
    unknown_score: float
    unknown_id: int
    longest: int
    by_words: bool

    @staticmethod
    def of(pieces: list[tuple[str, float, int]]) -> Vocabulary:
        own = {p.encode(): i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
        byte_id = np.full(256, -1, np.int32)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == BYTE:
                byte_id[int(p[3:5], 16)] = i
        unknown = next((i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN), 0)
        score = np.array([s for _, s, _ in pieces])
        normal = [s for _, s, kind in pieces if kind == NORMAL]
        top, low = max(normal), min(normal)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == USER:  # as the public implementation scores them
                score[i] = len(p) * top - 0.1
        crossing = any(re.search(f"[^{MARK}]{MARK}|\n", p) for p, _, kind in pieces if kind in (NORMAL, USER))
        return Vocabulary(tuple(pieces), *double_array(own), score, byte_id, low - UNKNOWN_PENALTY, unknown, max(map(len, own)), not crossing)

    @staticmethod
    def load(path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return Vocabulary.of(read_pieces(f.read()))

    def fallback(self, char: bytes) -> list[int]:
        ids = [int(self.byte_id[b]) for b in char]
        return ids if min(ids) >= 0 else [self.unknown_id]

    def encode_word(self, word: bytes) -> tuple[list[int], float]:
        """Ids and score of one word, byte by byte."""
        n = len(word)
        best, back = [-np.inf] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0
        base, check, value, score = self.base, self.check, self.value, self.score
        i = 0
        while i < n:
            width = 1 if word[i] < 0x80 else 2 if word[i] < 0xE0 else 3 if word[i] < 0xF0 else 4
            s, here, alone = 0, best[i], False
            for k in range(i, min(n, i + self.longest)):
                t = int(base[s]) + word[k]
                if check[t] != s or t == 0:
                    break
                s = t
                if (v := int(value[s])) >= 0:
                    alone |= k + 1 - i == width
                    if here + score[v] > best[k + 1]:
                        best[k + 1], back[k + 1] = here + score[v], (i, v)
            if not alone and here + self.unknown_score > best[i + width]:
                best[i + width], back[i + width] = here + self.unknown_score, (i, -1)
            i += width
        out, at = [], n
        while at:
            start, v = back[at]
            out += [v] if v >= 0 else self.fallback(word[start:at])[::-1]
            at = start
        return out[::-1], float(best[n]) if n else 0.0

    def _encode_alike(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """words: bytes, one row a word, zero beyond lengths. An id at the byte where a piece starts (each byte of a fallback), else -1; and the scores."""
        n, width = words.shape
        best = np.full((n, width + 1), -np.inf)
        start, piece = np.zeros((n, width + 1), np.int16), np.full((n, width + 1), -1, np.int32)
        best[:, 0] = 0.0
        lead = words[:, :]
        wide = np.where(lead < 0x80, 1, np.where(lead < 0xC0, 0, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))).astype(np.int8)
        for i in range(width):
            rows = np.flatnonzero((lengths > i) & (wide[:, i] > 0))
            if not len(rows):
                continue
            here, w = best[rows, i], wide[rows, i]
            alone = np.zeros(len(rows), bool)
            live, s = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for k in range(i, min(width, i + self.longest)):
                r = rows[live]
                inside = lengths[r] > k
                if not inside.all():
                    live, s, r = live[inside], s[inside], r[inside]
                t = self.base[s] + words[r, k]
                ok = (self.check[t] == s) & (t != 0)
                live, s = live[ok], t[ok]
                if not len(live):
                    break
                v = self.value[s]
                hit = np.flatnonzero(v >= 0)
                if len(hit):
                    h, vh = live[hit], v[hit]
                    alone[h[w[h] == k + 1 - i]] = True
                    now, r = here[h] + self.score[vh], rows[h]
                    better = now > best[r, k + 1]
                    r = r[better]
                    best[r, k + 1], start[r, k + 1], piece[r, k + 1] = now[better], i, vh[better]
            h = np.flatnonzero(~alone)
            if len(h):
                r, end, now = rows[h], i + w[h].astype(np.int64), here[h] + self.unknown_score
                better = now > best[r, end]
                r, end = r[better], end[better]
                best[r, end], start[r, end], piece[r, end] = now[better], i, -1
        out, at, rows = np.full((n, width), -1, np.int32), lengths.astype(np.int64).copy(), np.flatnonzero(lengths > 0)
        while len(rows):
            end = at[rows]
            begin, v = start[rows, end].astype(np.int64), piece[rows, end]
            known = v >= 0
            out[rows[known], begin[known]] = v[known]
            r, b, e = rows[~known], begin[~known], end[~known]
            for k in range(4):
                inside = b + k < e
                r, b, e = r[inside], b[inside], e[inside]
                if not len(r):
                    break
                ids = self.byte_id[words[r, b + k]]
                out[r, b + k] = np.where(ids >= 0, ids, self.unknown_id if k == 0 else -1)
            at[rows] = begin
            rows = rows[begin > 0]
        return out, best[np.arange(n), lengths]

    def cuts(self, word: bytes) -> np.ndarray:
        """The places in a word, its end included, over which neither a piece nor a character reaches: the best path goes through all of them."""
        own = np.frombuffer(word, np.uint8)
        n = len(own)
        start = np.flatnonzero((own & 0xC0) != 0x80)
        reach = np.append(start[1:], n)
        live, s = np.arange(len(start)), np.zeros(len(start), np.int32)
        for k in range(self.longest):
            inside = start[live] + k < n
            live, s = live[inside], s[inside]
            t = self.base[s] + own[start[live] + k]
            ok = (self.check[t] == s) & (t != 0)
            live, s = live[ok], t[ok]
            if not len(live):
                break
            hit = live[self.value[s] >= 0]
            reach[hit] = np.maximum(reach[hit], start[hit] + k + 1)
        return np.append(start[1:], n)[np.maximum.accumulate(reach) <= np.append(start[1:], n)]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids one word after another, the first place of each word (one more than words), and scores."""
        if all(len(w) <= LONG for w in words):
            return self._encode_parts(words)
        parts: dict[bytes, int] = {}
        codes, owner = [], []
        for i, w in enumerate(words):
            if len(w) <= LONG:
                own = [w]
            else:
                ends = self.cuts(w).tolist()
                own = [w[a:b] for a, b in zip([0, *ends], ends)]
            codes += [parts.setdefault(x, len(parts)) for x in own]
            owner += [i] * len(own)
        ids, place, scores = self._encode_parts(list(parts))
        code, owners = np.array(codes, np.int64), np.array(owner, np.int64)
        sizes = np.diff(place)[code]
        after = np.concatenate([[0], np.cumsum(sizes)])
        out = ids[np.repeat(place[:-1][code] - after[:-1], sizes) + np.arange(after[-1])]
        per_word = np.bincount(owners, sizes, len(words)).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(per_word)]), np.bincount(owners, scores[code], len(words))

    def _encode_parts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(w) for w in words], np.int64) if words else np.zeros(0, np.int64)
        per_word: list = [None] * len(words)
        scores = np.zeros(len(words))
        order = np.argsort(sizes, kind="stable")
        order, long = order[sizes[order] <= LONG], order[sizes[order] > LONG]
        for i in long:
            ids, scores[i] = self.encode_word(words[i])
            per_word[i] = np.array(ids, np.int32)
        at = 0
        counts = np.zeros(len(words), np.int64)
        flat = []
        while at < len(order):
            size = int(sizes[order[at]])
            stop = min(int(np.searchsorted(sizes[order], max(size + 3, size * 5 // 4), side="right")), at + 16384)
            some = order[at:stop]
            width = max(1, int(sizes[some[-1]]))
            block = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in some), np.uint8).reshape(len(some), width)
            ids, scores[some] = self._encode_alike(block, sizes[some])
            counts[some] = (ids >= 0).sum(1)
            flat.append((some, ids[ids >= 0]))
            at = stop
        for i in long:
            counts[i] = len(per_word[i])
        place = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(place[-1], np.int32)
        for some, ids in flat:
            n = counts[some]
            out[np.repeat(place[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = ids
        for i in long:
            out[place[i] : place[i + 1]] = per_word[i]
        return out, place, scores

    def words_of(self, text: str) -> list[str | None]:
        """The words of a text that are decoded apart; None for a marker that stands in the text itself."""
        out: list[str | None] = []
        for k, part in enumerate(text.split(MARK)) if text else ():
            part = (" " if k == 0 else "") + part
            out += [None] * (k > 0)
            part = part.replace(" ", MARK)
            out += (re.findall(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+", part) if self.by_words else [part]) if part else []
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of one text."""
        out: list[int] = []
        for word in self.words_of(text or ""):
            out += self.fallback(MARK_BYTES) if word is None else self.encode_words([word.encode()])[0].tolist()
        return out

    def spellings(self) -> list[bytes]:
        """What each id adds to a decoded text."""
        return [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind in (CONTROL, UNUSED) else " ⁇ ".encode() if kind == UNKNOWN else p.replace(MARK, " ").encode() for p, _, kind in self.pieces]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the blank that encoding put first is dropped, bytes that are no UTF-8 become U+FFFD."""
        table = self.spellings()
        return b"".join(table[i] for i in ids).removeprefix(b" ").decode("utf-8", "replace")


def encode_chunk(vocabulary: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts without nulls: all ids, each text's first place (one more than texts), and scores."""
    n = len(texts)
    plain = pc.invert(pc.or_(pc.match_substring(texts, MARK), pc.match_substring(texts, CUT))).to_numpy(zero_copy_only=False) if vocabulary.by_words else np.zeros(n, bool)
    full = pc.not_equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    easy = np.flatnonzero(plain & full)
    marked = pc.binary_join_element_wise(" ", texts.take(pa.array(easy)), "")
    marked = pc.replace_substring(marked, " ", CUT + MARK)
    for _ in range(2):  # runs of markers stay together
        marked = pc.replace_substring(marked, MARK + CUT + MARK, MARK + MARK)
    marked = pc.replace_substring(marked, "\n", CUT + "\n" + CUT)
    parts = pc.split_pattern(marked, CUT)
    ends = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
    ends -= ends[0]
    distinct = [w.encode() for w in coded.dictionary.to_pylist()]
    code_of: dict[bytes | None, int] = {w: i for i, w in enumerate(distinct)}
    hard = {}
    for i in np.flatnonzero(~plain & full):
        own = [w if w is None else w.encode() for w in vocabulary.words_of(texts[int(i)].as_py())]
        for w in own:
            if w not in code_of:
                code_of[w] = len(distinct)
                distinct.append(w)
        hard[int(i)] = np.array([code_of[w] for w in own], np.int64)
    marker = code_of.get(None, -1)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if hard:  # put the words of all texts in order
        where = dict(zip(easy.tolist(), range(len(easy))))
        lists = [hard[i] if i in hard else codes[ends[where[i]] : ends[where[i] + 1]] if i in where else codes[:0] for i in range(n)]
        codes, ends = np.concatenate(lists) if lists else codes, np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    else:
        sizes = np.zeros(n, np.int64)
        sizes[easy] = np.diff(ends)
        ends = np.concatenate([[0], np.cumsum(sizes)])
    ids, place, scores = vocabulary.encode_words([b"" if i == marker else w for i, w in enumerate(distinct)])
    if marker >= 0:
        own = np.array(vocabulary.fallback(MARK_BYTES), np.int32)
        ids, at = np.insert(ids, place[marker], own), place.copy()
        at[marker + 1 :] += len(own)
        place = at
        scores[marker] = vocabulary.unknown_score
    lens = np.diff(place)[codes]
    after = np.concatenate([[0], np.cumsum(lens)])
    gathered = ids[np.repeat(place[:-1][codes] - after[:-1], lens) + np.arange(after[-1])] if len(codes) else ids[:0]
    total = np.concatenate([[0.0], np.cumsum(scores[codes])])
    return gathered, after[ends], total[ends[1:]] - total[ends[:-1]]


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", check: bool = True) -> DataFrame:
    """key, ids, n_ids, n_bytes (ids that spell single bytes), score and, with check, round_trip: whether decoding gives the text back."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))  # bounded by the vocabulary
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary.value
        spelled = own.spellings()
        is_byte = np.zeros(len(own.pieces), bool)
        is_byte[own.byte_id[own.byte_id >= 0]] = True
        for rows in chunks(batches, "_text"):
            texts = texts_of(rows, "_text")
            ids, place, scores = encode_chunk(own, texts)
            out = {"key": rows.column("_key").combine_chunks(), "ids": pa.ListArray.from_arrays(pa.array(place.astype(np.int32)), pa.array(ids)), "n_ids": pa.array(np.diff(place)), "n_bytes": pa.array(np.diff(np.concatenate([[0], np.cumsum(is_byte[ids])])[place])), "score": pa.array(scores)}
            if check:
                # spell all ids of the chunk at once; a text is the bytes between its ids
                sizes = np.array([len(s) for s in spelled], np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes[ids])])[place]
                whole = b"".join(map(spelled.__getitem__, ids.tolist()))
                out["round_trip"] = pa.array([whole[a:b].removeprefix(b" ") == t.encode() for a, b, t in zip(ends[:-1].tolist(), ends[1:].tolist(), texts.to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    schema = f"key {kind}, ids array<int>, n_ids long, n_bytes long, score double" + ", round_trip boolean" * check
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and text of rows of ids; null ids give a null text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = vocabulary.value.spellings()
        for batch in batches:
            texts = [None if x is None else b"".join(map(spelled.__getitem__, x)).removeprefix(b" ").decode("utf-8", "replace") for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(texts, pa.string())], names=["key", "text"])

    return encoded.select(F.col(key).alias("_key"), F.col(ids).alias("_ids")).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)
