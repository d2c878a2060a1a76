"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (DIMENSIONS long, seeded by its code point). A
trigram's vector binds its letters' vectors, permuted by place: roll(a, 2) * roll(b, 1) * c. A
text's vector bundles (adds) those of all its trigrams, a language's prototype those of its
training texts, and the prediction is the prototype of the largest cosine.

Texts are read whole: lower case, everything but letters one blank, a blank before and after.
The prototypes are fitted on a bounded sample of labelled rows: of each label those whose key's
hash falls under TRAINING_ROWS over the label's row count, so that rare labels are learned from
all their rows. They are a few KB a language and broadcast. Vectors of trigrams are made a block
at a time, so that memory does not grow with a text's length.

Defined results: a null text or one without a letter is `und` with score 0, as is every text if
nothing was learned; ties go to the language first by name; a negative cosine scores 0; repeated
rows are predicted each on their own; an empty table gives an empty result; key and text (and
the label, for training alone) are read, no other column. Rows without a key are in the sample or
out of it together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinstone.llm.common import chunks, texts_of

DIMENSIONS = 1024
SEED = 20240501
#: Bound on the labelled rows of one label that its prototype is fitted on.
TRAINING_ROWS = 5_000
#: Tasks that fit, each of which returns one vector a label.
FITTERS = 32
#: Labels whose shares are broadcast: a few MB.
BROADCAST_LABELS = 50_000
#: Texts of a chunk; with so many, (text, trigram) fits 64 bits whatever the letters.
ROWS = 1024
#: Trigrams whose vectors are made at a time; and those of a chunk whose vectors are kept for all its texts.
BLOCK, KEPT = 8192, 1 << 16

_letters: np.ndarray | None = None
_vectors: dict[int, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter's code point; 0 if it is no letter."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and (s := chr(c)).isalpha():
                table[c] = ord(s.lower()[0])
        _letters = table
    return _letters


def letter_vector(c: int) -> np.ndarray:
    if c not in _vectors:
        if len(_vectors) > 16384:
            _vectors.clear()
        _vectors[c] = np.random.Generator(np.random.PCG64([SEED, c])).integers(0, 2, DIMENSIONS, np.int8) * 2 - 1
    return _vectors[c]


def trigram_vectors(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """One row of +1 and -1 a trigram; codes: places of its letters in letters, in base len(letters)."""
    k = len(letters)
    used, places = np.unique(np.stack([codes // (k * k), codes // k % k, codes % k]), return_inverse=True)
    own, (a, b, c) = np.stack([letter_vector(int(x)) for x in letters[used]]), places.reshape(3, -1)
    return np.roll(own, 2, 1)[a] * np.roll(own, 1, 1)[b] * own[c]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """letters; then sorted by text: the text, trigram code and count of each text's distinct trigrams."""
    table = letter_table()
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    # a blank before and after every text
    whole = np.zeros(len(points) + 2 * len(texts), np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes + 2)
    whole[np.arange(len(points)) + np.repeat(2 * np.arange(len(texts)) + 1, sizes)] = table[points]
    keep = np.ones(len(whole), bool)
    keep[1:] = (whole[1:] != 0) | (whole[:-1] != 0) | (owner[1:] != owner[:-1])
    whole, owner = whole[keep], owner[keep]
    letters = np.unique(whole)
    dense = np.searchsorted(letters, whole).astype(np.int64)
    k = len(letters)
    codes = (dense[:-2] * k + dense[1:-1]) * k + dense[2:]
    one = owner[:-2] == owner[2:]
    both, counts = np.unique(owner[:-2][one] * k**3 + codes[one], return_counts=True)
    return letters, both // k**3, both % k**3, counts


def _fit_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for rows in chunks([batch], "_text", 4 << 20, ROWS):
            labels = np.array(rows.column("_label").to_pylist(), object)
            letters, owner, codes, counts = trigrams(texts_of(rows, "_text").to_pylist())
            if not len(codes):
                continue
            for label in sorted(set(labels)):
                of = labels[owner] == label
                some, at = np.unique(codes[of], return_inverse=True)
                weight = np.bincount(at, counts[of], len(some))
                total = sums.setdefault(label, np.zeros(DIMENSIONS))
                for i in range(0, len(some), BLOCK):
                    total += weight[i : i + BLOCK].astype(np.float64) @ trigram_vectors(some[i : i + BLOCK], letters)
    if sums:
        yield pa.record_batch({"label": pa.array(list(sums), pa.string()), "total": pa.array([v.tobytes() for v in sums.values()], pa.binary())})


def shares(counts: dict[str, int], rows: int = TRAINING_ROWS) -> dict[str, float]:
    """The share of each label's rows that the sample takes."""
    return {label: min(1.0, rows / n) for label, n in counts.items()}


def sampled(docs: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """docs of which each label's rows are thinned to about `rows` by a hash of their key."""
    counts = {r["l"]: r["n"] for r in docs.groupBy(F.col(label).alias("l")).agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}  # a row a language
    share = shares(counts, rows)
    taken = docs.sparkSession.createDataFrame(list(share.items()), f"_l {docs.schema[label].dataType.simpleString()}, _share double")
    luck = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(key)), 11).cast("double") * 2.0**-53
    return docs.join(F.broadcast(taken) if len(share) <= BROADCAST_LABELS else taken, F.col(label) == F.col("_l")).where(luck < F.col("_share"))


def fit(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", label: str = "lang", rows: int = TRAINING_ROWS) -> dict[str, np.ndarray]:
    """A prototype of length 1 for each label, from at most about `rows` rows of it among those that training names."""
    own = docs.where(training & F.col(label).isNotNull()).select(F.col(key).alias("_key"), F.col(label).alias("_label"), F.col(text).alias("_text"))
    some = sampled(own, "_key", "_label", rows).where("_text is not null").select(F.col("_label").cast("string").alias("_label"), "_text").repartition(FITTERS, F.xxhash64("_text"))
    sums: dict[str, np.ndarray] = {}
    for row in some.mapInArrow(_fit_part, "label string, total binary").toLocalIterator():
        sums[row["label"]] = sums.get(row["label"], 0) + np.frombuffer(row["total"])
    return {k: v / norm for k, v in sorted(sums.items()) if (norm := np.linalg.norm(v)) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((list(prototypes), np.stack(list(prototypes.values())).astype(np.float32) if prototypes else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, planes = shared.value
        for rows in chunks(batches, "_text", 4 << 20, ROWS):
            texts = texts_of(rows, "_text").to_pylist()
            n = len(texts)
            best, score = [None] * n, np.zeros(n)
            letters, owner, codes, counts = trigrams(texts)
            if planes is not None and len(codes):
                some, at = np.unique(codes, return_inverse=True)
                few = len(some) <= KEPT
                vectors = np.concatenate([trigram_vectors(some[i : i + BLOCK], letters) for i in range(0, len(some), BLOCK)]) if few else None
                blank = int(np.searchsorted(letters, 0)) if 0 in letters else -1
                k = len(letters)
                lettered = (codes // (k * k) != blank) | (codes // k % k != blank) | (codes % k != blank)
                place = np.searchsorted(owner, np.arange(n + 1))
                for i in range(n):
                    if not lettered[place[i] : place[i + 1]].any():
                        continue
                    own = np.zeros(DIMENSIONS, np.float32)
                    for j in range(place[i], place[i + 1], BLOCK):
                        mine = slice(j, min(j + BLOCK, place[i + 1]))
                        own += counts[mine].astype(np.float32) @ (vectors[at[mine]] if few else trigram_vectors(codes[mine], letters)).astype(np.float32)
                    if norm := float(np.linalg.norm(own)):
                        cosines = planes @ own / norm
                        j = int(np.argmax(cosines))
                        best[i], score[i] = labels[j], min(1.0, max(0.0, float(cosines[j])))
            yield pa.record_batch({"key": rows.column("_key").combine_chunks(), "lang_pred": pa.array([b or "und" for b in best], pa.string()), "score": pa.array(score)})

    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)
