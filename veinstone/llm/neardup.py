"""Near-duplicates by BagMinHash over multisets of word 5-shingles.

A text is the multiset of its 5-word windows (of all its words if it has fewer than five). Two
texts are linked if their weighted Jaccard similarity, the sum of smaller counts over the sum of
larger ones, is at least 0.8; classes are the connected components of the links.

BagMinHash: each shingle runs a Poisson process over its weight axis, cut into dyadic shells
[0, 1), [1, 2), [2, 4), ...; a shell's process has the shell's width as rate, and a point is
located in it by halving, so that points beyond the text's count are left out. A point has a
random signature component; a component keeps its earliest point. Two texts agree in a component
with probability equal to their weighted Jaccard similarity. Points are generated in order of
time, for all shingles of a chunk of texts at once, up to a time by which all components of a
text are filled almost surely (else up to double that time).

Candidates share the key of one of BANDS bands of ROWS components (missing a pair at similarity
0.8: 2e-5). Texts with equal words are one class before that; of them one stands for all. In each
bucket every text is verified against the bucket's first, whose text is sent once to each of as
many lots of members as their size asks for; the components that arise are joined. Buckets that
still hold more than one component go through tiles of bounded rows and shingles: first their
signatures say which texts may be similar to one of another component (estimate of at least
ESTIMATE, over five standard deviations below 0.8), then these texts' multisets are compared, and
links that join components are returned. So no pair that shares a bucket is left unlooked at,
pairs are never emitted, and a group of any number of copies costs one verification per member and
bucket. A bucket of n texts of which few resemble its first sends each row to n / TILE tiles.

Keys may be of any type that can be ordered. A row is known by 128 bits of its key and text, so
rows of one key with different texts, or without a key, are rows of their own.

Defined results: one row of the result for each row of the input; a null text or one without words
is in no class but its own; class_id is the least key of the class, null only if none of its rows
has a key; kept marks the row of that key (of several such rows that of the least hash, of rows
equal in key and text all); an empty table gives an empty result; key and text are read, no other
column. Shingles and words are compared by 64-bit hashes, whole texts by 128 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinstone.llm.common import chunks, coded_words, column, discard, fresh, hash_strings, mix64, texts_of, uniform, whole_groups, written
from veinstone.llm.graph import components

SHINGLE = 5
BANDS, ROWS = 36, 6
COMPONENTS = BANDS * ROWS
SIMILAR = 0.8
ESTIMATE = 0.65
#: Rows, and shingles, of a bucket that one task compares with as many others.
TILE, TILE_SHINGLES = 1024, 1 << 21
#: Shingles of a bucket that are compared with its first text in one lot.
LOT_SHINGLES = 1 << 21
GOLD = 0x9E3779B97F4A7C15


def times_gold(k: int, odd: int = GOLD) -> np.uint64:
    return np.uint64(k * odd & 0xFFFFFFFFFFFFFFFF)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by text: the text, hash and count of its distinct shingles; and two 64-bit digests of each text's words (0, 0 without words)."""
    codes, ends, distinct = coded_words(texts)
    n = len(texts)
    words = hash_strings(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(n), sizes)
    place = (np.arange(len(words)) - ends[:-1][owner]).astype(np.uint64)
    digests = np.zeros((2, n), np.uint64)
    for k in range(2):
        mixed = mix64(words + (place + np.uint64(1)) * np.uint64((0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)[k]))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        digests[k] = np.where(sizes > 0, mix64(sums[ends[1:]] - sums[ends[:-1]] + sizes.astype(np.uint64) * np.uint64(GOLD)) | np.uint64(1), np.uint64(0))
    hashed = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        hashed = mix64(hashed + words[k : len(words) - SHINGLE + 1 + k] + np.uint64(GOLD)) if len(hashed) else hashed
    starts = np.flatnonzero(owner[: len(hashed)] == owner[SHINGLE - 1 :]) if len(hashed) else np.zeros(0, np.int64)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    who = np.concatenate([owner[starts], short])
    what = np.concatenate([hashed[starts], digests[0][short]])
    if not len(who):
        return who, what, np.zeros(0, np.int64), digests
    order = np.lexsort((what, who))
    who, what = who[order], what[order]
    first = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (what[1:] != what[:-1])]))
    return who[first], what[first], np.diff(np.append(first, len(who))), digests


def bag_minhash(owner: np.ndarray, items: np.ndarray, weights: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """Signatures, n rows of m times (infinite for texts without items); owner is sorted."""
    times = np.full((n, m), np.inf)
    flat = times.reshape(-1)
    total = np.bincount(owner, weights, n)
    limit = np.zeros(n)
    np.divide(m * (math.log(m) + 3.0), total, out=limit, where=total > 0)
    open_ = total > 0
    while open_.any():
        mine = open_[owner]
        own, item, weight = owner[mine], items[mine], weights[mine]
        shell = 0
        while len(own):
            low, width = (0, 1) if shell == 0 else (1 << (shell - 1), 1 << (shell - 1))
            reach = weight > low
            own, item, weight = own[reach], item[reach], weight[reach]
            at, seed, until, weigh, until_own = np.zeros(len(own)), mix64(item + times_gold(shell + 1, 0xA0761D6478BD642F)), limit[own], weight, own
            step = 0
            while len(at):
                step += 1
                bits = mix64(seed + times_gold(step))
                at = at - np.log(uniform(bits)) / width
                live = np.flatnonzero(at <= until)
                if not len(live):
                    break
                at, seed, until, weigh, until_own, bits = at[live], seed[live], until[live], weigh[live], until_own[live], bits[live]
                more = mix64(bits ^ np.uint64(0xE7037ED1A0B428DB))
                spot = until_own * m + ((more >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
                if shell < 2:
                    np.minimum.at(flat, spot, at)
                else:  # halve down to a unit of the shell: the bits, from the highest, say which half
                    inside = low + ((more & np.uint64(0xFFFFFFFF)) * np.uint64(width) >> np.uint64(32)).astype(np.int64) < weigh
                    np.minimum.at(flat, spot[inside], at[inside])
            shell += 1
        limit *= 2
        open_ &= np.isinf(times).any(1)
    return times


def band_keys(times: np.ndarray) -> np.ndarray:
    bits = times.view(np.uint64).reshape(len(times), BANDS, ROWS)
    keys = np.broadcast_to(mix64(np.arange(1, BANDS + 1).astype(np.uint64) * np.uint64(GOLD)), (len(times), BANDS)).copy()
    for k in range(ROWS):
        keys = mix64(keys + bits[:, :, k])
    return keys.view(np.int64)


def short_signatures(times: np.ndarray) -> np.ndarray:
    return (mix64(times.view(np.uint64)) >> np.uint64(40)).astype(np.int32)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.reshape(-1)))


SIGNED = "h1 long, h2 long, d1 long, d2 long, weight long, bands array<long>, signature binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text", 3 << 20, 1024):
        owner, items, weights, digests = shingles(texts_of(rows, "text"))
        times = bag_minhash(owner, items, weights, rows.num_rows)
        yield pa.RecordBatch.from_arrays(
            [*(column(rows, c) for c in ("key", "h1", "h2")), *(pa.array(d.view(np.int64)) for d in digests), pa.array(np.bincount(owner, weights, rows.num_rows).astype(np.int64)), _lists(band_keys(times)), pa.array([x.tobytes() for x in short_signatures(times)], pa.binary())],
            names=["key", "h1", "h2", "d1", "d2", "weight", "bands", "signature"],
        )


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Sums of smaller and of larger counts of two sorted multisets (hashes, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common, int(a[1].sum() + b[1].sum()) - common


def bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts of which some may be equal: each text's place among the different ones, and of these first item, owner, items, weights."""
    coded = texts.dictionary_encode()
    owner, items, weights, _ = shingles(coded.dictionary)
    return coded.indices.to_numpy(), np.searchsorted(owner, np.arange(len(coded.dictionary) + 1)), owner, items, weights


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by a and lot, each lot's hub (b null) before its members: the members similar to their hub."""
    hub = None
    for rows in chunks(batches, "text", 6 << 20, 4096):
        code, ends, _, items, weights = bags(texts_of(rows, "text"))
        a, b = column(rows, "a").to_numpy(), column(rows, "b").to_pylist()
        found = []
        for i, k in enumerate(code):
            own = items[ends[k] : ends[k + 1]], weights[ends[k] : ends[k + 1]]
            if b[i] is None:
                hub = own
                continue
            s, u = similarity(hub, own)
            if s * 10 >= u * 8:
                found.append((int(a[i]), b[i]))
        yield pa.record_batch({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts (rid, text) are similar; size: shingles of a's bucket, by which its members are dealt to lots."""
    lots = F.ceil(F.col("size") / LOT_SHINGLES).cast("int")
    dealt = pairs.withColumn("lots", lots).withColumn("lot", F.pmod(F.xxhash64("b"), F.col("lots")).cast("int"))
    members = dealt.join(texts, F.col("b") == F.col("rid")).select("a", "lots", "lot", "b", "text")
    hubs = dealt.select("a", "lots", "lot").distinct().join(texts, F.col("a") == F.col("rid")).select("a", "lots", "lot", F.lit(None).cast("long").alias("b"), "text")
    keys = ["a", "lots", "lot"]
    return members.union(hubs).repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_first("b")).mapInArrow(_verify, "a long, b long")


TILED = ["band", "i", "j"]


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each tile that the signatures say may be similar to a row of another component."""
    for table, starts in whole_groups(batches, TILED, 16 << 20):
        roots, weights, chunk, i, j = (table.column(c).to_numpy() for c in ("root", "weight", "chunk", "i", "j"))
        signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.int32).reshape(len(roots), COMPONENTS)
        open_ = np.zeros(len(roots), bool)
        for s, e in zip(starts[:-1], starts[1:]):
            left, right = s + np.flatnonzero(chunk[s:e] == i[s]), s + np.flatnonzero(chunk[s:e] == j[s])
            for x in left:
                y = right[(roots[right] != roots[x]) & (10 * np.minimum(weights[right], weights[x]) >= 8 * np.maximum(weights[right], weights[x]))]
                if len(y):
                    y = y[(signs[y] == signs[x]).sum(1) >= ESTIMATE * COMPONENTS]
                    open_[y] = True
                    open_[x] |= len(y) > 0
        yield from table.select([*TILED, "chunk", "rid", "root"]).filter(pa.array(open_)).to_batches()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join the components of each tile's texts, verified one by one; no more links than joins."""
    for table, starts in whole_groups(batches, TILED, 16 << 20):
        ids, roots, chunk, i, j = (table.column(c).to_numpy() for c in ("rid", "root", "chunk", "i", "j"))
        code, ends, _, items, weights = bags(column(table, "text"))
        out = []
        for s, e in zip(starts[:-1], starts[1:]):
            mine = [slice(ends[k], ends[k + 1]) for k in code[s:e]]
            sizes = np.array([m.stop - m.start for m in mine])
            owner = np.repeat(np.arange(e - s), sizes)
            every, counts = np.concatenate([items[m] for m in mine]), np.concatenate([weights[m] for m in mine])
            distinct, at = np.unique(every, return_inverse=True)
            place, total = np.concatenate([[0], np.cumsum(sizes)]), np.bincount(owner, counts, e - s)
            group, marks, left, right = roots[s:e].copy(), np.zeros(len(distinct)), chunk[s:e] == i[s], chunk[s:e] == j[s]
            for x in np.flatnonzero(left):
                own = slice(place[x], place[x + 1])
                marks[at[own]] = counts[own]
                common = np.bincount(owner, np.minimum(marks[at], counts), e - s)
                marks[at[own]] = 0
                for y in np.flatnonzero(right & (group != group[x]) & (10 * common >= 8 * (total + total[x] - common))):
                    if group[y] != group[x]:
                        out.append((ids[s + x], ids[s + y]))
                        group[group == group[y]] = group[x]
        yield pa.record_batch({"a": pa.array([min(p) for p in out], pa.int64()), "b": pa.array([max(p) for p in out], pa.int64())})


def by_tile(rows: DataFrame) -> DataFrame:
    return rows.repartition(*TILED).sortWithinPartitions(*TILED)


def _row_hash(seed: int, key: str, text: str):
    return F.xxhash64(F.lit(seed), F.col(key).isNull(), F.col(key), F.col(text))


def _classed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, h1 and h2 (which say the row) of every row, and first: whether it has no key, key, h1 and h2 of its class's first row."""
    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("key"), _row_hash(0, key, text).alias("h1"), _row_hash(1, key, text).alias("h2"), F.col(text).alias("text"))
    signed = written(named.mapInArrow(_sign, f"key {kind}, {SIGNED}"), "signatures")
    row = F.struct(F.col("key").isNull().alias("none"), "key", "h1", "h2")
    # texts of equal words: the first row stands for all
    equal = signed.where("weight > 0").groupBy("d1", "d2").agg(F.min(row).alias("first"), *(F.first(c).alias(c) for c in ("weight", "bands", "signature")))
    reps = written(equal.withColumn("rid", F.monotonically_increasing_id()), "representatives")
    keyed = reps.select("rid", "weight", F.explode("bands").alias("band"))
    buckets = keyed.groupBy("band").agg(F.min(F.struct("rid", "weight")).alias("hub"), F.count(F.lit(1)).alias("n"), F.sum("weight").alias("size")).where("n > 1")
    shared = written(keyed.join(buckets, "band").select("band", "n", "size", "rid", "weight", "hub"), "buckets")
    alike = lambda x, y: 10 * F.least(x, y) >= 8 * F.greatest(x, y)
    star = shared.where((F.col("rid") != F.col("hub.rid")) & alike(F.col("weight"), F.col("hub.weight"))).groupBy(F.col("hub.rid").alias("a"), F.col("rid").alias("b")).agg(F.max("size").alias("size"))
    wanted = reps.select("rid", "first.h1", "first.h2").join(shared.select("rid").distinct(), "rid")
    texts = written(named.select("h1", "h2", "text").join(wanted, ["h1", "h2"]).dropDuplicates(["h1", "h2"]).select("rid", "text"), "candidate-texts")
    links = written(verified(star, texts), "star-links")
    # buckets of more than one component: their other pairs, by estimate
    labelled = shared.select("band", "n", "size", "rid", "weight").join(components(links), F.col("rid") == F.col("node"), "left").select("band", "n", "size", "rid", "weight", F.coalesce("root", "rid").alias("root"))
    mixed = labelled.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("band")
    tiles = F.ceil(F.greatest(F.col("n") / TILE, F.col("size") / TILE_SHINGLES)).cast("int")
    open_ = labelled.join(mixed, "band", "left_semi").join(reps.select("rid", "signature"), "rid").withColumn("tiles", tiles).withColumn("chunk", F.pmod(F.xxhash64("rid"), F.col("tiles")).cast("int"))
    spread = open_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other"))
    rest = written(by_tile(spread.select(*TILED, "chunk", "rid", "root", "weight", "signature")).mapInArrow(_across, "band long, i int, j int, chunk int, rid long, root long"), "unsettled")
    more = written(by_tile(rest.join(texts, "rid").select(*TILED, "chunk", "rid", "root", "text")).mapInArrow(_settle, "a long, b long").distinct(), "other-links")
    discard(rest, texts, shared)
    rooted = components(links.union(more)).join(reps.select("rid", "first"), F.col("node") == F.col("rid")).select("node", "root", "first")
    of_root = rooted.groupBy(F.col("root").alias("top")).agg(F.min("first").alias("first"))
    of_node = written(rooted.select("node", "root").join(of_root, F.col("root") == F.col("top")).select("node", "first"), "classes")
    discard(links, more)
    of_rep = reps.select("d1", "d2", "rid", F.col("first").alias("own")).join(of_node, F.col("rid") == F.col("node"), "left").select("d1", "d2", F.coalesce("first", "own").alias("first"))
    worded = signed.where("weight > 0").select("key", "h1", "h2", "d1", "d2").join(of_rep, ["d1", "d2"]).select("key", "h1", "h2", "first")
    return worded.union(signed.where("weight = 0").select("key", "h1", "h2", row.alias("first")))


def _is_first():
    return (F.col("h1") == F.col("first.h1")) & (F.col("h2") == F.col("first.h2"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, class_id (the least key of the class) and kept (whether this row stands for the class), one row for each of docs."""
    return _classed(docs, key, text).select(F.col("key").alias(key), F.col("first.key").alias("class_id"), _is_first().alias("kept"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each class: that of the least key, none last (of rows equal in key and text one)."""
    h1, h2, n = fresh(docs, "h1", "h2", "n")
    kept = _classed(docs, key, text).where(_is_first()).groupBy(F.col("h1").alias(h1), F.col("h2").alias(h2)).agg(F.count(F.lit(1)).alias(n))
    rows = docs.withColumns({h1: _row_hash(0, key, text), h2: _row_hash(1, key, text)}).join(kept, [h1, h2])
    return rows.where(F.col(n) == 1).select(*docs.columns).union(rows.where(F.col(n) > 1).dropDuplicates([h1, h2]).select(*docs.columns))
