"""Language-model scores from log-frequency Bloom filters of word pairs and character n-grams.

A text is its words between a start and an end. A token w after u, with c the training counts, N
their sum and V the number of distinct tokens, has the probability

    P_2(w | u) = (count(uw) + mu · P_1(w)) / (c(u) + mu)
    P_1(w) = (c(w) + V · P_0(w)) / (N + V)
    P_0(word) = (1 - e) · P(word),   P_0(end) = e, the share of ends among the training tokens

and P(text) is the product over its words and its end. c is exact; P(word) is a character model,
the product of P(c | up to ORDER - 1 characters before it) over the word's characters and its end,
each smoothed along its orders, which alone decides between words that training has not seen:

    P_k(c | h) = (count(hc) + KAPPA · P_{k-1}(c | h')) / (count(h) + KAPPA),   P_0 = 1 / 1114113

with h' the context without its first character.

The counts of all word pairs and of all character n-grams of the training words are quantised to
q = 1 + floor(log_B count) and held in Bloom filters as pairs (n-gram, 1) to (n-gram, q). A lookup
probes levels until one is missing and takes the mean of the counts of the level reached. An n-gram's
count is taken as no greater than its parts', since it cannot be more frequent.

mu is that of MUS under which all training tokens, each with its own
occurrence taken out of the counts, are the most probable: how much word pairs say is measured, not
assumed. Every text is scored by all of MUS in the one pass that reads its pairs.

The filters are split by ranges of the n-grams' keys (48 bits of their hash) into as many shards as
the input needs for at most SHARD keys in each. A shard's filter has BITS_PER_ENTRY bits for each
of its entries, so the error rate is the same at every size; it is built and probed in one task and
never broadcast. Chunks send each shard their distinct keys, packed, and get back the levels.

Counts cover all training texts. Texts are coded once, by chunks of rows: each chunk's distinct
words with counts, its distinct word pairs with counts, and each text as places in the words. Words
are counted and joined as (chunk, word) rows, so the hottest word has one row a chunk; each word is
scored once; and the chunks' words return to the chunks' texts by key. What no later step reads is
deleted on the way.

Defined results: a null text is an empty one, whose only token is its end; rows with equal keys
are scored each on their own; without training rows V and N are 0 and base_score and score are
the sums' values for unknown tokens; an empty table gives an empty result; key and text are read,
no other column.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from veinstone.llm.common import chunks, coded_words, discard, discard_part, hash_strings, mix64, texts_of, written, written_by

ORDER = 5
KAPPA = 4.0
#: Ratio of neighbouring count levels.
BASE = 1.5
HASHES = 4
BITS_PER_ENTRY = 10
#: Weights of P_1 in P_2, in counts, of which one is chosen; the first without training tokens.
MUS = (4.0, 1.0, 16.0, 64.0, 256.0, 1024.0, 4096.0, 16384.0)
#: Tasks that the chunks are dealt to at most; one may take several chunks, one after another.
WIDEST = 20_000
#: The most keys of one shard, were all of the input's n-grams different.
SHARD = 1 << 23
#: Tokens that are scored at once.
BLOCK = 1 << 18
#: Words that are scored at once.
BATCH = 1 << 16
ALPHABET = 1114113
START, END = 0x110000, 0x110001


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """The mean of the counts of a level; 0 for level 0."""
    return np.where(level > 0, (np.ceil(BASE ** (level - 1.0) - 1e-9) + np.ceil(BASE**level - 1e-9) - 1) / 2, 0.0)


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """word of each predicted character, and by order k (0 to ORDER) the hash of the k characters that end with it; 0 where there are fewer."""
    sizes = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    whole = np.empty(len(points) + 2 * len(words), np.uint64)
    ends = np.cumsum(sizes + 2)
    starts = ends - sizes - 2
    owner = np.repeat(np.arange(len(words)), sizes + 2)
    whole[starts], whole[ends - 1] = START, END
    whole[np.arange(len(points)) + np.repeat(2 * np.arange(len(words)) + 1, sizes)] = points
    place = np.arange(len(whole)) - starts[owner]
    hashes = [np.zeros(len(whole), np.uint64)]
    for k in range(1, ORDER + 1):
        grown = np.zeros(len(whole), np.uint64)
        ok = place >= k - 1
        before = np.zeros(len(whole), np.uint64)
        before[1:] = hashes[k - 1][:-1]
        grown[ok] = mix64(before[ok] * np.uint64(0x9FB21C651E98DF25) + whole[ok] + np.uint64(k)) | np.uint64(1)
        hashes.append(grown)
    return owner, place, hashes


def counted(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the n-grams of words that occur so often. The word's start counts as a context alone."""
    owner, _, hashes = ngrams(words)
    every = np.concatenate([h for h in hashes[1:]])
    times = np.concatenate([counts[owner]] * ORDER)
    some, back = np.unique(every[every != 0], return_inverse=True)
    return some, np.bincount(back, times[every != 0], len(some)).astype(np.int64)


def spots(items: np.ndarray, level: int | np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of (item, level): HASHES places in one block of 512 bits, so that a probe touches one cache line."""
    mixed = mix64(items + np.asarray(level).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    block = (mixed >> np.uint64(36)) % np.uint64(bits // 512) * np.uint64(512)
    for k in range(HASHES):
        yield block + (mixed >> np.uint64(9 * k) & np.uint64(511))


@dataclass
class Model:
    """One filter as 64-bit words, and the share of ends; total: characters and ends of the training words."""

    filter: np.ndarray
    end_share: float
    total: float

    def has(self, items: np.ndarray, level: int) -> np.ndarray:
        out = np.ones(len(items), bool)
        for at in spots(items, level, len(self.filter) * 64):
            out &= (self.filter[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out

    def levels(self, items: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The level of each item, by probes from 1 up to most."""
        level = np.zeros(len(items), np.int64)
        live = np.flatnonzero((items != 0) & (most > 0))
        step = 1
        while len(live):
            live = live[self.has(items[live], step)]
            level[live] = step
            step += 1
            live = live[most[live] >= step]
        return level

    def word_scores(self, words: list[str]) -> np.ndarray:
        """log10 P of each word, its end included."""
        return word_scores(words, self.total, lambda items: self.levels(items, np.full(len(items), 99)))


def filled(items: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The filter of distinct items: BITS_PER_ENTRY bits an entry, whatever their number."""
    top = level_of(counts)
    bits = max(1, -(-int(top.sum()) * BITS_PER_ENTRY // 512)) * 512
    out = np.zeros(bits // 64, np.uint64)
    for k in range(1, int(top.max(initial=0)) + 1):
        for at in spots(items[top >= k], k, bits):
            np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def word_scores(words: list[str], total: float, levels: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """log10 P of each word, its end included, by the levels of n-grams."""
    if not words:
        return np.zeros(0)
    owner, place, hashes = ngrams(words)
    predicted = place > 0
    n = len(place)
    # distinct n-grams are looked up once; level[k] is that of the k characters up to here
    level = [np.full(n, 99, np.int64)]
    for k in range(1, ORDER + 1):
        before = np.zeros(n, np.int64)
        before[1:] = level[k - 1][:-1]
        most = np.minimum(before, level[k - 1]) if k > 1 else np.full(n, 99)
        some, back = np.unique(hashes[k], return_inverse=True)
        level.append(np.minimum(np.where(some != 0, levels(some), 0)[back], most))
    p = np.full(n, 1.0 / ALPHABET)
    for k in range(1, ORDER + 1):
        here = count_of(level[k])
        if k == 1:
            context = np.full(n, total)
        else:
            context = np.zeros(n)
            context[1:] = count_of(level[k - 1][:-1])
        has = place >= k - 1
        p = np.where(has, (np.minimum(here, context) + KAPPA * p) / (context + KAPPA), p)
    return np.bincount(owner[predicted], np.log10(p[predicted]), len(words))


def pack_longs(values: np.ndarray) -> bytes:
    """int64 values, byte by byte of their eight, compressed; sorted keys go in as differences."""
    return pa.compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def unpack_longs(blob: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(pa.decompress(blob, n * 8, "zstd", asbytes=True), np.uint8).reshape(8, n).T).view("<i8").reshape(-1)


def keyed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys (48 bits) of hashes, with the sums of their counts."""
    keys, back = np.unique(hashes >> np.uint64(16), return_inverse=True)
    return keys, np.bincount(back, counts, len(keys)).astype(np.int64)


def marked(hashes: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """keyed for counts of 0 and 1, in place of hashes: they are sorted with the count as last bit."""
    sort_marked(hashes, train)
    return unmarked(hashes)


def sort_marked(hashes: np.ndarray, train: np.ndarray) -> None:
    hashes >>= np.uint64(16)
    hashes <<= np.uint64(1)
    hashes |= train
    hashes.sort()


def unmarked(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and counts of what sort_marked made, or of a stretch of whole keys of it."""
    new = np.ones(len(hashes), bool)
    np.greater(hashes[1:] ^ hashes[:-1], 1, out=new[1:])  # more than the last bit differs
    starts = np.flatnonzero(new)
    counts = np.add.reduceat((hashes & np.uint64(1)).view(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
    return hashes[starts] >> np.uint64(1), counts


SHARDED = "chunk long, shard int, m long, keys binary, counts binary"
#: What the rows of coded texts are.
WORDS, TEXTS, PAIRS = 0, 1, 2


def sharded(chunk: int, keys: np.ndarray, counts: np.ndarray, shards: int) -> Iterator[tuple]:
    """(chunk, shard, number, keys, counts) for each shard that has some of the sorted keys; the shards' order is the keys'."""
    cuts = np.searchsorted((keys * np.uint64(shards)) >> np.uint64(48), np.arange(shards + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        mine = slice(cuts[k], cuts[k + 1])
        yield chunk, k, int(cuts[k + 1] - cuts[k]), pack_longs(np.diff(keys[mine].astype(np.int64), prepend=0)), pack_longs(counts[mine])


def sharded_marks(chunk: int, hashes: np.ndarray, train: np.ndarray, shards: int) -> Iterator[tuple]:
    """sharded of marked, a shard at a time."""
    sort_marked(hashes, train)
    cuts = np.searchsorted(hashes, np.array([-(-(k << 48) // shards) << 1 for k in range(shards + 1)], np.uint64)).tolist()
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if b > a:
            keys, counts = unmarked(hashes[a:b])
            yield chunk, k, len(keys), pack_longs(np.diff(keys.astype(np.int64), prepend=0)), pack_longs(counts)


def probe_shard(table: pa.Table) -> pa.Table:
    """One shard: its filter, filled with the counts of all chunks, and the levels of each chunk's keys."""
    sizes = table.column("m").to_pylist()
    keys = np.concatenate([np.cumsum(unpack_longs(b, m)) for b, m in zip(table.column("keys").to_pylist(), sizes)]).astype(np.uint64)
    counts = np.concatenate([unpack_longs(b, m) for b, m in zip(table.column("counts").to_pylist(), sizes)])
    items, back = np.unique(keys, return_inverse=True)
    total = np.bincount(back, counts, len(items)).astype(np.int64)
    model = Model(filled(items[total > 0], total[total > 0]), 0.0, 0.0)
    found = model.levels(items, np.full(len(items), 99)).astype(np.uint8)[back]
    ends = np.cumsum(sizes)
    blobs = [pa.compress(found[e - m : e].tobytes(), "zstd", asbytes=True) for e, m in zip(ends, sizes)]
    return pa.table({"chunk": table.column("chunk"), "shard": table.column("shard"), "m": table.column("m"), "levels": pa.array(blobs, pa.binary())})


def probed(rows: DataFrame) -> DataFrame:
    """chunk, shard, m and levels of sharded rows."""
    return rows.select("chunk", "shard", "m", "keys", "counts").groupBy("shard").applyInArrow(probe_shard, "chunk long, shard int, m long, levels binary")


def levels_of(shard: list, m: list, blobs: list) -> np.ndarray:
    """The levels of a chunk's sorted keys, from its rows of all shards."""
    parts = [np.frombuffer(pa.decompress(b, n, "zstd", asbytes=True), np.uint8) for _, n, b in sorted(zip(shard, m, blobs))]
    return np.concatenate([np.zeros(0, np.uint8), *parts])


def pair_hashes(words: np.ndarray, places: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the texts' words as places in hashes of words: previous token, token (len(words) is the start, one more the end), and the pair's hash."""
    left, right = np.insert(places, ends[:-1], len(words)), np.insert(places, ends[1:], len(words) + 1)
    every = np.concatenate([words, np.array([START, END], np.uint64)])
    return left, right, mix64(every[left] * np.uint64(0x9FB21C651E98DF25) + every[right])


def pair_hashes_alone(words: np.ndarray, places: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes that pair_hashes gives, of about BLOCK tokens at a time."""
    tokens = ends + np.arange(len(ends))
    out = np.empty(tokens[-1], np.uint64)
    cuts = np.unique(np.searchsorted(tokens, np.arange(0, tokens[-1] + BLOCK, BLOCK)).clip(max=len(ends) - 1)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        out[tokens[a] : tokens[b]] = pair_hashes(words, places[ends[a] : ends[b]], ends[a : b + 1] - ends[a])[2]
    return out


def tally(codes: np.ndarray, n: int) -> np.ndarray:
    """How often each of n codes occurs; few are widened at a time."""
    out = np.zeros(n, np.int64)
    for at in range(0, len(codes), 4 * BLOCK):
        out += np.bincount(codes[at : at + 4 * BLOCK], minlength=n)
    return out


def pack(places: np.ndarray) -> bytes:
    """int32 places, byte by byte of their four, compressed."""
    return pa.compress(places.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True) if len(places) else b""


def unpack(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int32)
    return np.ascontiguousarray(np.frombuffer(pa.decompress(blob, n * 4, "zstd", asbytes=True), np.uint8).reshape(4, n).T).view("<i4").reshape(-1)


def coded(docs: DataFrame, training: Column, key: str, text: str, shards: int) -> DataFrame:
    """Rows of three kinds by chunk: its WORDS (word, place in the chunk, training count), its TEXTS (key, held_out, n_words, places), and its word PAIRS by shard (shard, m, keys, counts)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn = TaskContext.get().partitionId(), 0
        for rows in chunks(batches, "_text", 24 << 20, 1 << 16):
            codes, ends, distinct = coded_words(pc.ascii_lower(texts_of(rows, "_text")))
            train = rows.column("_train").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
            sizes = np.diff(ends)
            counts, times = tally(codes[np.repeat(train, sizes)], len(distinct)), tally(codes, len(distinct))
            some = np.flatnonzero(times)
            some = some[np.argsort(-times[some], kind="stable")]  # common words get small places, which pack well
            chunk = (part << 32) + turn
            turn += 1
            n = len(some)
            dense = np.zeros(len(distinct), np.int32)
            dense[some] = np.arange(n)
            words = distinct.take(pa.array(some))
            yield rows_of(n, WORDS, chunk=np.full(n, chunk), word=words, place=np.arange(n, dtype=np.int32), n=counts[some])
            n = rows.num_rows
            places = dense[codes]
            del codes, distinct, dense, counts, times, some
            packed = pa.array([pack(places[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.binary())
            yield rows_of(n, TEXTS, chunk=np.full(n, chunk), key=rows.column("_key").combine_chunks(), held_out=~train, n_words=sizes, places=packed)
            del rows, packed
            pairs = pair_hashes_alone(hash_strings(words), places, ends)
            del words, places
            some = list(sharded_marks(chunk, pairs, np.repeat(train, sizes + 1), shards))
            del pairs
            yield rows_of(len(some), PAIRS, **{c: [x[k] for x in some] for k, c in enumerate(("chunk", "shard", "m", "keys", "counts"))})
            del some
            pa.default_memory_pool().release_unused()

    def rows_of(n: int, kind: int, /, **columns) -> pa.RecordBatch:
        columns["kind"] = np.full(n, kind, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in fields], schema=fields)

    fields = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("word", pa.string()), ("place", pa.int32()), ("n", pa.int64()), ("key", to_arrow_type(docs.schema[key].dataType)), ("held_out", pa.bool_()), ("n_words", pa.int64()), ("places", pa.binary()), ("shard", pa.int32()), ("m", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
    schema = f"kind int, chunk long, word string, place int, n long, key {kind}, held_out boolean, n_words long, places binary, shard int, m long, keys binary, counts binary"
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.coalesce(training, F.lit(False)).alias("_train")).mapInArrow(run, schema)


def words_scored(words: DataFrame, total: float, shards: int) -> DataFrame:
    """word, c, p and h of words (word, c): the character model's log10 P, and the word's hash. Written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                some = batch.slice(at, BATCH)
                chunk = (part << 32) + turn
                turn += 1
                texts, c = some.column("word").to_pylist(), some.column("c").to_numpy()
                rows = [(chunk, None, None, None, None, texts, c.tolist())]
                rows += [(*x, None, None) for x in sharded(chunk, *keyed(*counted(texts, c)), shards)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(fields)], schema=fields)

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            texts, c = left.column("words")[0].as_py(), left.column("c")[0].as_py()
            keys = keyed(*counted(texts, np.array(c)))[0]
            level = levels_of(*[right.column(x).to_pylist() for x in ("shard", "m", "levels")])
            p = word_scores(texts, total, lambda items: level[np.minimum(np.searchsorted(keys, items >> np.uint64(16)), len(keys) - 1)].astype(np.int64))
            out = [texts, c, p, hash_strings(pa.array(texts)).view(np.int64)]
        return pa.table([pa.array(x, t) for x, t in zip(out or [[]] * 4, (pa.string(), pa.int64(), pa.float32(), pa.int64()))], names=["word", "c", "p", "h"])

    fields = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("m", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("words", pa.list_(pa.string())), ("c", pa.list_(pa.int64()))])
    rows = written(words.select("word", "c").mapInArrow(run, f"{SHARDED}, words array<string>, c array<long>"), "ngrams")
    listed = rows.where("words is not null").select("chunk", "words", "c")
    scored = written(listed.groupBy("chunk").cogroup(probed(rows.where("words is null")).groupBy("chunk")).applyInArrow(judge, "word string, c long, p float, h long"), "scores")
    discard(rows)
    return scored


def shards_for(keys: int | None) -> int:
    return max(1, -(-int(keys or 0) // SHARD))


def score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every text."""
    # a text of x characters has at most x / 2 + 1 words, and one pair more
    most = docs.agg(F.sum(F.coalesce(F.length(text), F.lit(0)) / 2 + 2)).first()[0]
    rows = written_by(coded(docs, training, key, text, shards_for(most)), "kind", "coded")
    words, texts = rows.where(F.col("kind") == WORDS).select("chunk", "word", "place", "n"), rows.where(F.col("kind") == TEXTS).select("chunk", "key", "held_out", "n_words", "places")
    levels = written(probed(rows.where(F.col("kind") == PAIRS)), "levels")
    discard_part(rows, f"kind={PAIRS}")
    totals = written(words.groupBy("word").agg(F.sum("n").alias("c")), "words")
    size = F.length("word") + 1
    n, v, total_chars, n_grams = totals.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum(F.col("c") * size), F.sum((size + 1) * ORDER)).first()
    n_ends = texts.where("not held_out").count()
    n, v = (n or 0) + n_ends, v + (n_ends > 0)
    scored = words_scored(totals, float(total_chars or 0), shards_for(n_grams))
    discard(totals)
    back = lambda own: own.select("chunk", "word", "place").join(scored, "word").select(F.col("chunk").alias("part"), "place", "c", "p", "h")
    kind = dict(texts.dtypes)["key"]
    ends = n_ends / n if n else 0.5

    def one(c: np.ndarray, p: np.ndarray, n: int) -> np.ndarray:
        """log10 P_1 of words and, last, the end, by counts and log10 P."""
        p0 = 10.0**p * (1 - ends)
        p0[-1] = ends
        if n:
            p1 = np.log10(np.maximum((c + v * p0) / (n + v), 1e-300))
        else:
            p1 = p + math.log10(1 - ends)
            p1[-1] = math.log10(ends)
        # a long unknown word's P is below the least number, but its logarithm is not
        tiny = (c == 0) & (p < -250)
        p1[tiny] = p[tiny] + math.log10(max(1 - ends, 1e-300)) + (math.log10(v / (n + v)) if n else 0)
        return p1

    def two(count: np.ndarray, context: np.ndarray, p1: np.ndarray, plain: np.ndarray, mu: float) -> np.ndarray:
        """log10 of (count + mu P_1) / (context + mu), of log10 P_1 and P_1; mu P_1 alone where the pair is unseen, which keeps small values."""
        return np.where(count > 0, np.log10(count + mu * plain, where=count > 0, out=np.zeros(len(p1))), p1 + math.log10(mu)) - np.log10(context + mu)

    def opened(left: pa.Table, right: pa.Table) -> tuple:
        """A chunk's texts, their words' counts c and log10 P, the texts' first tokens, and by block its slice, previous tokens, tokens, and the pairs' counts."""
        pairs = left.filter(pc.is_valid(left.column("shard")))
        left = left.filter(pc.is_valid(left.column("n_words")))
        place = right.column("place").to_numpy()
        size = int(place.max()) + 1 if len(place) else 0
        # the last two are the start, as frequent as the end, and the end
        c, p, h = np.full(size + 2, n_ends), np.zeros(size + 2), np.zeros(size, np.uint64)
        c[place], p[place], h[place] = right.column("c").to_numpy(), right.column("p").to_numpy(), right.column("h").to_numpy().view(np.uint64)
        sizes = left.column("n_words").to_numpy()
        blobs = left.column("places").to_pylist()
        tokens = np.concatenate([[0], np.cumsum(sizes + 1)])
        cuts = np.unique(np.searchsorted(tokens, np.arange(0, tokens[-1] + BLOCK, BLOCK)).clip(max=len(sizes))).tolist()
        blocks = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]

        def paired(block: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at = np.concatenate([np.zeros(0, np.int32), *[unpack(blob, m) for m, blob in zip(sizes[block].tolist(), blobs[block])]])
            return pair_hashes(h, at, np.concatenate([[0], np.cumsum(sizes[block])]))

        def counted_blocks() -> Iterator[tuple]:
            every = np.concatenate([np.zeros(0, np.uint64), *[paired(x)[2] >> np.uint64(16) for x in blocks]])
            every.sort()
            keys = every[np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])[: len(every)])]
            del every
            level = levels_of(*[pairs.column(x).to_pylist() for x in ("shard", "m", "places")])
            for block in blocks:
                before, here, hashes = paired(block)
                count = count_of(level[np.searchsorted(keys, hashes >> np.uint64(16))].astype(np.int64))
                yield block, before, here, np.minimum(count, np.minimum(c[before], c[here]))

        return left, c, p, tokens, counted_blocks()

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        """A text's measures, its score by each of MUS, and the same sum with each token's own occurrence left out, 0 for held-out texts."""
        left, c, p, tokens, blocks = opened(left, right)
        less = np.maximum(c - 1, 0)
        base, known, p1, without = np.log10((c + 1) / (n + v + 1)), c > 0, one(c, p, n), one(less, p, max(n - 1, 1))
        plain, plain_without = 10.0**p1, 10.0**without
        train = ~left.column("held_out").to_numpy().astype(bool)
        n_known, base_score, scores, told = [], [], [[] for _ in MUS], [[] for _ in MUS]
        for block, before, here, count in blocks:
            starts = tokens[block.start : block.stop] - tokens[block.start]  # every text has its end, so no sum is empty
            use = np.repeat(train[block], np.diff(tokens[block.start : block.stop + 1]))
            n_known.append(np.add.reduceat(known[here].astype(np.int64), starts))
            base_score.append(np.add.reduceat(base[here], starts))
            own, other = (count, c[before], p1[here], plain[here]), (np.maximum(count - 1, 0)[use], less[before[use]], without[here[use]], plain_without[here[use]])
            for k, mu in enumerate(MUS):
                scores[k].append(np.add.reduceat(two(*own, mu), starts))
                each = np.zeros(len(use))
                each[use] = two(*other, mu)
                told[k].append(np.add.reduceat(each, starts))
        whole = lambda parts, kind: pa.array(np.concatenate([np.zeros(0), *parts]).astype(kind))
        return pa.table({
            "key": left.column("key"), "held_out": left.column("held_out"), "n_tokens": pa.array(np.diff(tokens)), "n_known": whole(n_known, np.int64), "train_tokens": pa.array(np.full(len(left), n, np.int64)),
            "base_score": whole(base_score, float), **{f"score_{k}": whole(x, float) for k, x in enumerate(scores)}, **{f"told_{k}": whole(x, float) for k, x in enumerate(told)},
        })

    own = "".join(f", {x}_{k} double" for x in ("score", "told") for k in range(len(MUS)))
    schema = f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double{own}"
    found = levels.select("chunk", F.lit(None).cast(kind).alias("key"), F.lit(None).cast("boolean").alias("held_out"), F.lit(None).cast("long").alias("n_words"), F.col("levels").alias("places"), "shard", "m")
    both = texts.select("*", F.lit(None).cast("int").alias("shard"), F.lit(None).cast("long").alias("m")).union(found)
    tasks = max(1, min(levels.select("chunk").distinct().count(), WIDEST))  # about a chunk a task
    every = written(both.repartition(tasks, "chunk").groupBy("chunk").cogroup(back(words).repartition(tasks, "part").groupBy("part")).applyInArrow(total, schema), "scores")
    sums = every.agg(*[F.sum(f"told_{k}") for k in range(len(MUS))]).first() if n else [None]
    best = max(range(len(MUS)), key=lambda k: (sums[k], -MUS[k])) if sums[0] is not None else 0
    return every.select(F.col("key").alias(key), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", F.col(f"score_{best}").alias("score"))
