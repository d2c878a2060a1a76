"""Each operator against a brute-force version, a round trip or held-out accuracy, and its edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from veinstone.llm import langid, license, lm, mixing, neardup, pieces, pii, quality, queries, vectors, warc
from veinstone.llm.common import coded_words, crc_mod

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, `key` string, `_text` string"
ODD = [None, "", " \n\t ", "one", "a b c d", "x" * 30000, "é ▁ \U0001f600 \x1f 日本語", "the end " * 9000, "# | % $ & < > *", "1 2 3 4 5 6 7 8 9 10 11"]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def rows(documents):
    return documents.collect()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    data = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None, "k", "t") for i, t in enumerate(ODD)]
    return spark.createDataFrame(data + data[-2:], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- WARC --------------------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    big, small = "é<p>" * 400, "tiny"
    pages = spark.createDataFrame([(1, "http://a/ b", big), (2, None, big), (9, "http://a/", big), (3, "u", small), (4, "u", small), (5, "u", None), (6, "u", "a\nfiledesc://x 0 0 0 0\r\n\r\nWARC/1.0\r\n" * 50), (7, "u", "x" * 5_000_000), (7, "u", "x" * 5_000_000)], "page_id long, url string, html string")
    arc, out = str(tmp_path / "arc"), str(tmp_path / "warc")
    warc.write_arc(pages, arc)
    warc.convert(spark, arc, out)
    got = warc.warc_records(spark, out).collect()
    assert len(got) == 9 and all(r["digests_agree"] for r in got)
    by = {r["order"]: r for r in got}
    assert by[9]["record_type"] == "response" and by[1]["refers_to"] == by[2]["refers_to"] == 9 and by[1]["refers_to_id"] == by[9]["record_id"]
    assert by[3]["record_type"] == by[4]["record_type"] == by[6]["record_type"] == "response"
    assert by[5]["payload_bytes"] == 0 and by[1]["payload_bytes"] == 2000 and by[1]["payload_digest"] == hashlib.sha1(big.encode()).hexdigest()
    assert by[1]["url"] == "http://a/%20b" and by[2]["url"] == "urn:unknown" and by[1]["warc_date"] == "2024-01-01T00:00:00Z"
    assert sorted(r["record_type"] for r in got if r["order"] == 7) == ["response", "revisit"]


def test_warc_members_and_clashing_columns(spark, tmp_path):
    """Each record is a gzip member of its own, whatever other columns the rows have."""
    pages = spark.createDataFrame([(k, "u", f"page {k} " * 300, "f", 0, "x") for k in range(5)], "page_id long, url string, html string, file string, offset long, value string")
    warc.write_arc(pages.coalesce(1), str(tmp_path / "arc"))
    warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    for folder, mark, n in (("arc", b"", 6), ("warc", b"WARC/1.0", 6)):
        (file,) = (tmp_path / folder).glob("part-*")
        data, members = file.read_bytes(), []
        while data:
            inflate = zlib.decompressobj(31)
            members.append(inflate.decompress(data))
            assert inflate.eof
            data = inflate.unused_data
        assert len(members) == n and all(m.startswith(mark) for m in members)
    assert [r["payload_bytes"] for r in warc.warc_records(spark, str(tmp_path / "warc")).collect()] == [2100] * 5


def test_gzip_members_end_in_zero():
    for data in (b"", b"x", bytes(range(256)) * 65536):
        squeezed = warc.member(data)
        assert squeezed.endswith(b"\0") and b"".join(warc.Stream._unzipped(squeezed, 4096)) == data


def test_broken_archives(spark, tmp_path):
    """What comes before the break is kept; the rest is one metadata record."""
    good = warc.arc_segment([("http://x/", 3, b"payload")], "1", "n", wrap=warc.member)
    line = b"http://x/ 0 0 text/html "
    rests = [warc.member(line + b"-5\nabc"), warc.member(line + b"99\nshort"), warc.member(line + b"many\nabc"), warc.member(b"no header\n"), b"\x1f\x8b garbage", good[:-20], warc.member(b"x" * 3_000_000)]
    for k, rest in enumerate(rests):
        records = list(warc.read_arc(good + rest))
        assert [r["broken"] for r in records][:2] == [False, False] and records[-1]["broken"] and len(records) == (4 if k == 5 else 3)
        (tmp_path / "arc").mkdir(exist_ok=True)
        (tmp_path / "arc" / f"{k}.arc.gz").write_bytes(good + rest)
    warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    got = warc.warc_records(spark, str(tmp_path / "warc")).collect()
    assert sorted(r["record_type"] for r in got) == ["metadata"] * 7 + ["response"] * 7
    assert all("broken at" in r["note"] for r in got if r["record_type"] == "metadata")
    whole = warc.warc_record(b"HTTP/1.1 200 OK\r\n\r\nx", "f", 0, warc.described(next(r for r in warc.read_arc(good) if r["url"] == "http://x/")))
    for bad in (whole + b"WARC/1.0\r\nWARC-Type: response\r\n\r\n", whole + b"WARC/1.0\r\nContent-Length: -1\r\n\r\n", whole + whole[:-10], whole + b"junk\n"):
        records = list(warc.read_warc(bad))
        assert [h["warc-type"] for h, _ in records] == ["response", "metadata"]


def test_warc_empty(spark, tmp_path):
    warc.write_arc(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "a"))
    warc.convert(spark, str(tmp_path / "a"), str(tmp_path / "w"))
    assert warc.warc_records(spark, str(tmp_path / "w")).count() == 0


def test_arc_versions():
    for version in "12":
        segment = warc.arc_segment([("http://x/", 3, b"a\nb"), ("dns:x", None, b"")], version, "n")
        about, first, second = warc.read_arc(segment)
        assert about["url"] == "filedesc://n" and first["version"] == version and warc.http_parts(first["block"])[1] == b"a\nb" and second["url"] == "dns:x"
    assert warc.iso_date("199612") == "1996-12-01T00:00:00Z" or warc.iso_date("19961231") == "1996-12-31T00:00:00Z"
    assert [r["broken"] for r in warc.read_arc(b"http://x/ 0 0 text/html 99\nshort")] == [True]


# --- SentencePiece -----------------------------------------------------------------------------


def small_vocabulary():
    spelled = ["a", "b", "ab", "abc", "c", "▁", "▁a", "▁ab", "bc", "▁▁", "é"]
    scores = [-3.0, -3.0, -4.0, -4.5, -3.0, -2.0, -4.0, -6.0, -5.0, -3.5, -6.0]
    return [("<unk>", 0.0, 2), ("<s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] + [(p, s, 1) for p, s in zip(spelled, scores)]


def brute_best(v, text):
    """The largest score over all ways to spell the text."""
    s = "▁" + text.replace(" ", "▁")
    own = {p: x for p, x, kind in v.pieces if kind == 1}
    best = {0: 0.0}
    for i in range(len(s)):
        for j in range(i + 1, len(s) + 1):
            if (x := own.get(s[i:j], v.unknown_score if j == i + 1 else None)) is not None:
                best[j] = max(best.get(j, -math.inf), best[i] + x)
    return best[len(s)]


def test_pieces_best_path_and_round_trip():
    v = pieces.Vocabulary.of(small_vocabulary())
    r = np.random.default_rng(5)
    texts = ["".join(r.choice(list("abc  é\nz▁\x1f日"), r.integers(0, 40))) for _ in range(300)] + ["ab" * 200, " ", "\n\n"]
    ids, place, scores = pieces.encode_chunk(v, pa.array(texts))
    for i, t in enumerate(texts):
        own = ids[place[i] : place[i + 1]].tolist()
        assert v.decode(own) == t and own == v.encode(t)
        if t and "▁" not in t:
            assert scores[i] == pytest.approx(brute_best(v, t))


def test_pieces_long_words():
    """What is cut has the best score of the whole, and comes back."""
    v = pieces.Vocabulary.of(small_vocabulary())
    r = np.random.default_rng(6)
    for alphabet in ("abc", "ab日本é", "日本語"):
        text = "".join(r.choice(list(alphabet), 700))
        word = ("▁" + text).encode()
        (ids, score), (own, _, scores) = v.encode_word(word), v.encode_words([word])
        assert scores[0] == pytest.approx(score) == pytest.approx(brute_best(v, text)) and v.decode(own.tolist()) == v.decode(ids) == text
        assert v.cuts(word)[-1] == len(word)
    assert len(v.cuts("日本語".encode() * 50)) == 150


def test_pieces_agree_with_library():
    """The same pieces in a Unigram model of the public library: the ids agree."""
    import sentencepiece

    model = open(queries.PIECES, "rb").read()

    def varint(n):
        out = b""
        while True:
            out += bytes([n & 127 | (128 if n > 127 else 0)])
            n >>= 7
            if not n:
                return out

    def message(fields):
        return b"".join(varint(f << 3 | 2) + varint(len(x)) + x if isinstance(x, bytes) else varint(f << 3) + varint(x) for f, x in fields)

    v = pieces.Vocabulary.load(queries.PIECES)
    parts, at = [], 0
    for field, value in pieces.wire(model):
        if field == 1:
            own = dict(pieces.wire(value))
            value = varint(1 << 3 | 2) + varint(len(own[1])) + own[1] + varint(2 << 3 | 5) + struct.pack("<f", v.pieces[at][1]) + varint(3 << 3) + varint(own.get(3, 1))
            at += 1
        if field == 2:  # trainer: the model type, 1 is Unigram; other fields are kept if they are numbers or texts
            value = message([(f, 1 if f == 3 else x) for f, x in pieces.wire(value) if f == 3 or not (isinstance(x, bytes) and len(x) in (4, 8))])
        parts.append((field, value))
    library = sentencepiece.SentencePieceProcessor(model_proto=message(parts))
    for text in ["Hello world", "the quick brown fox", "Thhehaer ertible", "été à la plage", "a  b   c", "x1 = 42;", "日本"]:
        assert v.encode(text) == library.encode(text) and library.decode(v.encode(text)) == text


def test_pieces_query(spark, rows, odd, empty):
    got = {r["doc_id"]: r for r in queries.op2_sentencepiece(spark, SF).collect()}
    assert len(got) == len(rows) and all(r["round_trip"] for r in got.values())
    encoded = pieces.encode(odd, queries.PIECES)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(encoded, queries.PIECES).collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)} and encoded.count() == len(ODD) + 2
    assert pieces.encode(empty, queries.PIECES).count() == 0


# --- quality rules -----------------------------------------------------------------------------


def repeat_words(words):
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    return len({j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 5)})


def test_quality_measures(spark, rows, odd):
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    for r in quality.judged(odd).collect():
        text = texts[r["doc_id"]] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words)) and r["n_repeat_words"] == repeat_words(words)
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["base_failed"] == (len(words) < 10 or 100 * repeat_words(words) > 20 * len(words)) and (not r["kept"] or not r["base_failed"])
    assert quality.judged(odd).count() == odd.count()


def test_quality_order_does_not_matter(documents, odd, empty):
    from pyspark.sql import functions as F

    docs = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    ordered, estimates = quality.plan(docs)
    assert {r.name for r in ordered} == {r.name for r in quality.RULES} and [e.name for e in estimates] == [r.name for r in ordered]
    verdicts = [[r[0] for r in docs.select(quality.rejection(F.col("text"), o).isNull()).collect()] for o in (quality.RULES, quality.RULES[::-1], ordered)]
    assert verdicts[0] == verdicts[1] == verdicts[2] and any(verdicts[0]) and not all(verdicts[0])
    assert quality.plan(empty) == (quality.RULES, []) and quality.filter_documents(empty).count() == 0 and quality.judged(empty).count() == 0
    assert quality.filter_documents(odd).columns == odd.columns
    assert sorted(r["doc_id"] for r in quality.filter_documents(docs).collect()) == sorted(r["doc_id"] for r in quality.judged(docs).where("kept").collect())


def test_quality_rules_by_worth():
    """A rule counts for what those before it leave."""
    a, b, c = (quality.Rule(n, None, "") for n in "abc")
    ordered, estimates = quality.by_worth((a, b, c), {"a": 1.0, "b": 2.0, "c": 1.0}, {0b000: 50, 0b001: 10, 0b011: 30, 0b100: 10})
    assert [r.name for r in ordered] == ["a", "c", "b"] and [round(e.rejected, 3) for e in estimates] == [0.4, 0.167, 0.0]


def test_quality_sample_comes_from_everywhere(spark):
    """The planner sees rows that stand at the end of the table."""
    from pyspark.sql import functions as F

    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, F.lit("# | # | # | # | # | # |")).otherwise(F.lit("short")).alias("text"))
    _, estimates = quality.plan(docs, sample_rows=400)
    found = {e.name: e.rejected for e in estimates}
    assert 0 < sum(found.values()) and all(x <= 1 for x in found.values())
    assert 0.3 < found[estimates[0].name] <= 1


# --- near-duplicates ---------------------------------------------------------------------------


def bag(text):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute_classes(texts):
    """Class by key of {key: text}: components of weighted Jaccard >= 0.8."""
    bags, root = {k: bag(t) for k, t in texts.items()}, {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(texts), 2):
        x, y = bags[a], bags[b]
        if x and y and 10 * min(x.total(), y.total()) >= 8 * max(x.total(), y.total()):
            low = (x & y).total()
            if 10 * low >= 8 * (x.total() + y.total() - low):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k: find(k) for k in texts}


def test_near_duplicates(spark, rows, odd, empty):
    texts = {r["doc_id"]: r["text"] for r in rows}
    got = {r["doc_id"]: r["class_id"] for r in queries.op4_near_duplicates(spark, SF).collect()}
    assert got == brute_classes(texts) and len(set(got.values())) < len(got)
    found = neardup.classes(odd).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == brute_classes(dict(enumerate(ODD))) and len(found) == odd.count()
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)
    assert neardup.classes(empty).count() == 0
    assert neardup.deduplicate(odd).count() == len(ODD) and neardup.deduplicate(odd).columns == odd.columns


def test_near_duplicates_without_keys(spark):
    """Different texts of one key, or of none, all stay; copies still fall together."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    data = [(None, text(1)), (None, text(2)), (None, text(2)), (7, text(3)), (7, text(4)), (8, text(4)), (None, text(4)), (9, text(5)), (9, text(5))]
    got = neardup.deduplicate(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted([(0, text(1)), (0, text(2)), (7, text(3)), (7, text(4)), (9, text(5))])


def test_near_duplicates_of_any_key(spark):
    """Keys of text, equal keys with different texts, and none: links are found whatever the keys."""
    base = [f"w{i}" for i in range(60)]
    near = lambda k: " ".join(base[:k] + [f"x{k}"] + base[k + 1 :])
    far = lambda k: " ".join(f"v{k}y{i}" for i in range(30))
    data = [("b", near(3)), ("a", far(1)), ("a", near(59)), ("c", far(2)), (None, far(2)), (None, far(3)), ("d", "one"), ("e", None), ("a", near(59))]
    docs = spark.createDataFrame(data, "name string, text string")
    got = sorted((str(r["name"]), str(r["class_id"]), r["kept"]) for r in neardup.classes(docs, "name").collect())
    assert got == sorted([("b", "a", False), ("a", "a", True), ("a", "a", True), ("a", "a", True), ("c", "c", True), ("None", "c", False), ("None", "None", True), ("d", "d", True), ("e", "e", True)])
    left = sorted((str(r["name"]), r["text"] or "") for r in neardup.deduplicate(docs, "name").collect())
    assert left == sorted([("a", far(1)), ("a", near(59)), ("c", far(2)), ("None", far(3)), ("d", "one"), ("e", "")])


def test_near_duplicates_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, 6, 7), (2, "a b c", 8, 9, 1), (2, "a b c", 8, 9, 1)], "doc_id long, text string, __h1 long, `__N` long, h2 long")
    assert [tuple(r) for r in neardup.deduplicate(docs).collect()] == [(1, "a b c", 5, 6, 7)]


def test_near_duplicates_do_not_depend_on_order(spark):
    r = np.random.default_rng(9)
    texts = [" ".join([f"t{k % 7}w{i}" for i in range(40)] + [f"z{k % 3}"]) for k in range(60)]
    data = [(int(x), t) for x, t in zip(r.integers(0, 20, 60), texts)]
    results = [sorted((x["doc_id"], x["class_id"], x["kept"]) for x in neardup.classes(spark.createDataFrame([data[i] for i in r.permutation(60)], "doc_id long, text string")).collect()) for _ in range(2)]
    assert results[0] == results[1] and len(results[0]) == 60


def test_near_duplicate_chains(spark, monkeypatch):
    """Members of a bucket that its first does not resemble are linked among themselves, in tiles too."""
    r = np.random.default_rng(3)
    base = [f"w{i}" for i in r.integers(0, 50, 120)]
    texts = {}
    for k in range(60):
        own = list(base)
        for i in r.integers(0, 120, 1 + k % 9):
            own[i] = f"n{r.integers(0, 9)}"
        texts[k] = " ".join(own)
    monkeypatch.setattr(neardup, "TILE", 8)
    monkeypatch.setattr(neardup, "LOT_SHINGLES", 500)
    got = {x["doc_id"]: x["class_id"] for x in neardup.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == brute_classes(texts)


def test_bag_minhash_is_unbiased():
    r = np.random.default_rng(1)
    a, b = r.integers(1, 40, 60), r.integers(1, 40, 60)
    items = np.arange(60).astype(np.uint64) * np.uint64(7919)
    m = 4096
    s = neardup.bag_minhash(np.repeat([0, 1], 60), np.concatenate([items, items]), np.concatenate([a, b]), 2, m)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - want) < 4 * math.sqrt(want * (1 - want) / m)


# --- language ----------------------------------------------------------------------------------


def test_language(spark, rows, odd, empty, documents):
    from pyspark.sql import functions as F

    lang = {r["doc_id"]: r["lang"] for r in rows}
    got = queries.op5_language(spark, SF).collect()
    held = [r for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    planes = langid.fit(documents, F.lit(True))
    pred = {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd, planes).collect()}
    assert [pred[i] == "und" for i in range(len(ODD))] == [not any(c.isalpha() for c in t or "") for t in ODD]
    assert langid.fit(empty, F.lit(True)) == {} and langid.predict(empty, planes).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd, {}).collect()} == {"und"}


def brute_language(texts, learn):
    """Prototypes and predictions with plain loops."""
    d = langid.DIMENSIONS

    def profile(text):
        s = " " + re.sub(" +", " ", "".join(c.lower()[0] if c.isalpha() else " " for c in text)).strip(" ") + " "
        s = s if s.strip() else ""
        total = np.zeros(d)
        for x, y, z in zip(s, s[1:], s[2:]):
            v = [langid.letter_vector(0 if c == " " else ord(c)).astype(float) for c in (x, y, z)]
            total += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
        return total if s else None

    planes = {}
    for text, label in learn:
        if (p := profile(text)) is not None:
            planes[label] = planes.get(label, 0) + p
    planes = {k: v / np.linalg.norm(v) for k, v in sorted(planes.items())}
    out = []
    for text in texts:
        p = profile(text or "")
        out.append(("und", 0.0) if p is None else max(((k, float(v @ p / np.linalg.norm(p))) for k, v in planes.items()), key=lambda x: x[1]))
    return out


def test_language_brute_force(spark, rows, documents, monkeypatch):
    from pyspark.sql import functions as F

    some = [r for r in rows if r["lang"] and len(r["text"] or "") < 3000][:40]
    texts = [r["text"] for r in some] + ["straße über", "İi 日本語 日本", "x", "1 2", None, "der die das " * 40]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    planes = langid.fit(spark.createDataFrame([(r["doc_id"], r["text"], r["lang"]) for r in some], "doc_id long, text string, lang string"), F.lit(True))
    want = brute_language(texts, [(r["text"], r["lang"]) for r in some])
    for kept in (1 << 16, 100):  # with and without vectors kept for the chunk
        monkeypatch.setattr(langid, "KEPT", kept)
        got = {r["doc_id"]: r for r in langid.predict(docs, planes).collect()}
        for i, (label, score) in enumerate(want):
            assert got[i]["lang_pred"] == label and got[i]["score"] == pytest.approx(max(0.0, score), abs=1e-5)


def test_language_sample_keeps_every_label(spark):
    """Rare labels survive beside frequent ones, and no number of rows rounds a share to nothing."""
    from pyspark.sql import functions as F

    assert langid.shares({"en": 10**11, "gd": 3}, 5000) == {"en": 5e-8, "gd": 1.0}
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2, "gd").otherwise("en").alias("lang"), F.when(F.col("id") < 2, "tha mi a dol").otherwise("the end of it").alias("text"))
    assert set(langid.fit(docs, F.lit(True), rows=50)) == {"en", "gd"}
    assert {r["lang"]: r["count"] for r in langid.sampled(docs, "doc_id", "lang", 50).groupBy("lang").count().collect()}["en"] in range(20, 90)


def test_language_ties(spark):
    planes = {"aa": np.ones(langid.DIMENSIONS) / 32, "bb": np.ones(langid.DIMENSIONS) / 32}
    assert {r["lang_pred"] for r in langid.predict(spark.createDataFrame([(1, "some words"), (2, "mehr")], "doc_id long, text string"), planes).collect()} <= {"aa"}


# --- language model ----------------------------------------------------------------------------


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute_base(texts, held):
    c = Counter(t for k, x in texts.items() if not held(k) for t in tokens(x))
    n, v = c.total(), len(c)
    return {k: (len(tokens(x)), sum(t in c for t in tokens(x)), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(x))) for k, x in texts.items()}


def test_lm_base_and_score(spark, rows):
    texts = {r["doc_id"]: r["text"] for r in rows}
    held = lambda k: zlib.crc32(str(k).encode()) % 7 == 2
    want = brute_base(texts, held)
    got = queries.op6_lm(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, held(r["doc_id"]))
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0 and math.isfinite(r["score"])
    out = [r for r in got if r["held_out"] and r["n_tokens"] > 50]
    assert sum(r["score"] for r in out) > 1.5 * sum(r["base_score"] for r in out)


def test_lm_edges(spark, odd, empty):
    got = lm.score(odd, crc_mod(odd["doc_id"], 7) != 2).collect()
    assert len(got) == len(ODD) + 2 and all(math.isfinite(r["score"]) for r in got)
    assert lm.score(empty, crc_mod(empty["doc_id"], 7) != 2).count() == 0


def test_lm_counts_from_probes():
    """The filter's counts are those of the text within a level, and rarely more."""
    words, counts = ["banana", "bandana", "an"], np.array([5, 70, 900])
    grams, n = lm.counted(words, counts)
    bits = 1 << 14
    filled = np.zeros(bits // 64, np.uint64)
    top = lm.level_of(n)
    for k in range(1, int(top.max()) + 1):
        for at in lm.spots(grams[top >= k], k, bits):
            np.bitwise_or.at(filled, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    model = lm.Model(filled, 0.1, float((counts * np.array([7, 8, 3])).sum()))
    found = model.levels(grams, np.full(len(grams), 99))
    assert (found >= top).all() and (found == top).mean() > 0.8
    likely, unlikely = model.word_scores(["an", "zq"])
    assert likely > -1 and unlikely < -8


def test_lm_order_of_words(spark):
    """Shuffled words score lower, in texts that training has and in those it has not."""
    said = ["the cat sat on the mat", "a dog ran to the old house", "the old cat ran to a house", "a dog sat on the mat"]
    data = [(i, said[i % 4], True) for i in range(40)]
    data += [(100, "the old dog sat on the mat", False), (101, "mat the on sat dog old the", False), (102, said[0], False), (103, "mat the on the sat cat", False)]
    docs = spark.createDataFrame(data, "doc_id long, text string, train boolean")
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, docs["train"]).collect()}
    assert got[100] > got[101] + 2 and got[102] > got[103] + 2


def brute_scores(texts, train):
    """Scores by plain formulas, with counts read from the same filters and the weight that leaves training tokens the most probable."""
    told = [tokens(t) for t in texts]
    c = Counter(t for own, use in zip(told, train) if use for t in own)
    n, v, n_ends = c.total(), len(c), c[None]
    words = sorted({t for own in told for t in own if t is not None})
    total = float(sum(c[w] * (len(w) + 1) for w in words))
    keys, counts = lm.keyed(*lm.counted(words, np.array([c[w] for w in words])))
    grams = lm.Model(lm.filled(keys[counts > 0], counts[counts > 0]), 0.0, 0.0)
    p = dict(zip(words, lm.word_scores(words, total, lambda items: grams.levels(items >> np.uint64(16), np.full(len(items), 99))).astype(np.float32).astype(float)))
    h = dict(zip(words, lm.hash_strings(pa.array(words)))) | {"START": np.uint64(lm.START), None: np.uint64(lm.END)}
    key = lambda a, b: lm.mix64(np.array([h[a]], np.uint64) * np.uint64(0x9FB21C651E98DF25) + h[b])[0] >> np.uint64(16)
    pairs = Counter(key(a, b) for own, use in zip(told, train) if use for a, b in zip(["START", *own], own))
    held = lm.Model(lm.filled(np.array(sorted(pairs), np.uint64), np.array([pairs[k] for k in sorted(pairs)])), 0.0, 0.0)
    ends = n_ends / n

    def score(own, mu, out):
        total = 0.0
        for a, b in zip(["START", *own], own):
            ca, cb = n_ends if a == "START" else c[a], c[b]
            count = min(float(lm.count_of(held.levels(np.array([key(a, b)], np.uint64), np.array([99])))[0]), ca, cb)
            p1 = (max(cb - out, 0) + v * (ends if b is None else 10 ** p[b] * (1 - ends))) / (n - out + v)
            total += math.log10((max(count - out, 0) + mu * p1) / (max(ca - out, 0) + mu))
        return total

    mu = max(lm.MUS, key=lambda m: sum(score(own, m, 1) for own, use in zip(told, train) if use))
    return [score(own, mu, 0) for own in told]


def test_lm_score_brute_force(spark, rows):
    texts = [r["text"] for r in rows[:60]] + [t for t in ODD if t is None or len(t) < 1000]
    train = [k % 5 != 0 for k in range(len(texts))]
    docs = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(zip(texts, train))], "doc_id long, text string, train boolean")
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, docs["train"]).collect()}
    for k, want in enumerate(brute_scores(texts, train)):
        assert got[k] == pytest.approx(want, rel=1e-6), k


def test_lm_weight_is_chosen_on_all_training_texts(spark):
    """Of many chunks, most repeat one text and the longer rest never does: the weight is that of all of them."""
    import random

    some = random.Random(5)
    word = lambda: "".join(some.choice("abcdefghij") for _ in range(3))
    texts = ["a cat sat on the mat again"] * 14 + [" ".join(word() for _ in range(400)) for _ in range(2)]
    rows = [(k, t, True) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string, train boolean")
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, docs["train"]).collect()}
    for k, want in enumerate(brute_scores(texts, [True] * len(texts))):
        assert got[k] == pytest.approx(want, rel=1e-6), k


def test_lm_codes_chunks_without_wide_copies():
    """Beside its results, coding takes less than 8 bytes a token, and so do the pairs' hashes and keys, which equal those made at once."""
    import tracemalloc

    def extra(make, held):
        tracemalloc.start()
        out = make()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, (peak - held(out)) / 1_200_000

    texts = pa.array([f"a{k}  b{k % 7} c\n" * 100 for k in range(4000)])
    (codes, ends, distinct), more = extra(lambda: coded_words(texts), lambda x: x[0].nbytes + x[1].nbytes)
    assert len(codes) == 1_200_000 and ends.tolist() == list(range(0, 1_200_001, 300)) and distinct[codes[301]].as_py() == "b1" and more < 8
    words = lm.hash_strings(distinct)
    hashes, more = extra(lambda: lm.pair_hashes_alone(words, codes, ends), lambda x: x.nbytes)
    assert more < 20 and (hashes == lm.pair_hashes(words, codes, ends)[2]).all()
    train = np.arange(len(hashes)) % 7 != 2
    want = list(lm.sharded(5, *lm.keyed(hashes, train), 40))
    spread = lm.mix64(np.arange(1_200_000).astype(np.uint64))
    wide = list(lm.sharded(5, *lm.keyed(spread, train[:1_200_000]), 40))
    assert list(lm.sharded_marks(5, hashes, train, 40)) == want
    got, more = extra(lambda: list(lm.sharded_marks(5, spread, train[:1_200_000], 40)), lambda x: sum(len(r[3]) + len(r[4]) for r in x))
    assert got == wide and more < 8
    none = np.zeros(0, np.uint64)
    assert list(lm.sharded_marks(5, none, none.astype(bool), 3)) == [] and len(lm.pair_hashes_alone(words, codes[:0], np.zeros(1, np.int64))) == 0


def test_lm_filters_hold_pairs_in_shards():
    """Levels of packed keys come back in the keys' order from any number of shards, at one error rate."""
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 64, 60000, np.uint64)
    counts = rng.integers(0, 4, 60000)
    keys, n = lm.keyed(hashes, counts)
    again, ones = lm.marked(np.repeat(hashes, counts + 1), np.concatenate([[0] + [1] * k for k in counts]).astype(bool))
    assert (again == keys).all() and (ones == n).all()
    for shards in (1, 7, 64):
        rows = list(lm.sharded(5, keys, n, shards))
        tables = [lm.probe_shard(pa.table({"chunk": [r[0]], "shard": [r[1]], "m": [r[2]], "keys": [r[3]], "counts": [r[4]]})) for r in rows]
        got = lm.levels_of([t["shard"][0].as_py() for t in tables], [t["m"][0].as_py() for t in tables], [t["levels"][0].as_py() for t in tables])
        want = np.where(n > 0, lm.level_of(np.maximum(n, 1)), 0)
        assert len(got) == len(keys) and (got >= want).all() and (got > want).mean() < 0.05


# --- licences ----------------------------------------------------------------------------------


def test_licences(spark, odd, empty):
    texts = {1: license.NOTICES["MIT-text"], 2: "intro\nLicensed under the Apache License, Version 2.0.\nend", 3: "Released under the MIT licence", 4: "# " + license.NOTICES["GPL-3.0"] + ".\n\nreleased  UNDER the mit License!", 5: "under the License"}
    got = {r["doc_id"]: r["licenses"] for r in license.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == {1: "MIT-text", 2: "Apache-2.0", 3: "", 4: "GPL-3.0,MIT", 5: ""}
    assert all(r["n_matches"] == 0 for r in license.scan(odd).collect()) and license.scan(empty).count() == 0


def brute_licences(text, templates):
    """The matches of every window that a template's words could fill with a third of its bigrams in place."""
    words = license.normal_words(text or "")
    grams, found = list(zip(words, words[1:])), []
    for rank, t in enumerate(templates.values()):
        placed = license.bigrams_of(t)
        m, own = len(placed), set(placed)
        votes = Counter(max(i - placed.index(x), 0) for i, x in enumerate(grams) if x in own)
        for a, n in votes.items():
            window = set(grams[a : a + m])
            both = len(window & own)
            if 3 * n >= len(own) and 20 * both >= 9 * (len(window) + len(own)):
                found.append((a, min(a + m, len(grams)), 2000 * both // (len(window) + len(own)), rank))
    inside = lambda x, o: o[0] <= x[0] and o[1] >= x[1] and (o[1] - o[0] > x[1] - x[0] or o[2] > x[2] or o[2] == x[2] and o[3] < x[3])
    return [x for x in found if not any(inside(x, o) for o in found)]


def test_licences_wrapped_and_whole(spark):
    """Notices in comments over code, whole licence texts, texts with a few words changed, and ties."""
    import textwrap

    every = license.templates_of()
    header, mit = license.NOTICES["GPL-3.0-header"], license.NOTICES["MIT-text"]
    comment = lambda t, mark: "\n".join(mark + x for x in textwrap.wrap(t, 40))
    code = "\nint main(void)\n{\n  return the_value(of, a, thing);\n}\n"
    texts = [comment(header, " * ") + code, "#!/bin/sh\n" + comment(mit, "# ") + code + comment(header, "// "), every["GPL-3.0-text"], "x y z " + every["Apache-2.0-text"] + code, every["GPL-2.0-text"].replace("the", "teh"), mit.replace("sublicense", "sell again"), header * 3, None, "", code * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = list(every)
    for r in license.scan(docs).collect():
        want = brute_licences(texts[r["doc_id"]], every)
        assert (r["n_matches"], r["licenses"], r["best_dice"]) == (len(want), ",".join(sorted({names[x[3]] for x in want})), max((x[2] for x in want), default=0)), r["doc_id"]
    got = {r["doc_id"]: r["licenses"] for r in license.scan(docs).collect()}
    assert got[0] == "GPL-3.0-header" and got[1] == "GPL-3.0-header,MIT-text" and got[2].startswith("GPL-3.0-text") and "Apache-2.0-text" in got[3] and got[5] == "MIT-text" and got[9] == ""
    same = {"b": "one two three four five", "a": "one two three four five"}
    assert license.scan(spark.createDataFrame([(1, "zero one two three four five six")], "doc_id long, text string"), templates=same).first()["licenses"] == "b"


def all_licences(text, templates, tenths):
    """(matches, windows that reach the threshold and are in the place of none): by votes, then of all other windows the best of each place."""
    words = license.normal_words(text or "")
    grams, found, left = list(zip(words, words[1:])), [], 0
    for rank, t in enumerate(templates.values()):
        placed = license.bigrams_of(t)
        m, own = len(placed), set(placed)
        votes = Counter(max(i - placed.index(x), 0) for i, x in enumerate(grams) if x in own)
        every = []
        for a in range(len(grams)):
            window = set(grams[a : a + m])
            if 20 * len(window & own) >= tenths * (len(window) + len(own)):
                every.append((a, min(a + m, len(grams)), 2000 * len(window & own) // (len(window) + len(own)), rank))
        shares = lambda x, o: 4 * (min(x[1], o[1]) - max(x[0], o[0])) > x[1] - x[0]
        kept = [x for x in every if 3 * votes[x[0]] >= len(own)]
        rest = [x for x in every if not any(shares(x, o) for o in kept)]
        while rest:
            best = max((x for x in rest if shares(x, rest[0])), key=lambda x: (x[2], -x[0]))
            kept.append(best)
            rest = [x for x in rest if not shares(x, rest[0]) and not shares(x, best)]
        found, left = found + kept, left + sum(not any(shares(x, o) for o in kept) for x in every)
    inside = lambda x, o: o[0] <= x[0] and o[1] >= x[1] and (o[1] - o[0] > x[1] - x[0] or o[2] > x[2] or o[2] == x[2] and o[3] < x[3])
    return [x for x in found if not any(inside(x, o) for o in found)], left


def test_licences_without_votes(spark):
    """a window that reaches the threshold is found though words put in leave no third of the template in place, alone and beside plain copies."""
    every = license.templates_of()
    mit = every["MIT-text"].split()
    q = len(mit) // 4
    moved = " ".join([*mit[:q], "zzz", *mit[q : 2 * q], "yyy", *mit[2 * q : 3 * q], "xxx", *mit[3 * q :]])
    half = " ".join(mit[: len(mit) // 2])
    texts = [moved, f"some code {moved} {' '.join(mit)} more {moved}", f"{moved} {moved} {moved}", f"{half} and {half}", " ".join(sorted(mit))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in license.scan(docs).collect()}
    assert got[0] == (1, "MIT-text", 966) and got[1] == (3, "MIT-text", 1000) and got[2][:2] == (3, "MIT-text") and got[3] == got[4] == (0, "", 0)


def test_licences_every_window(spark):
    """Against all windows of random texts: pieces of templates in any order, words put in and left out, copies side by side, few and many different words."""
    rng = random.Random(13)
    templates = {f"t{n}": " ".join(rng.choice([f"w{i}" for i in range(k)]) for _ in range(n)) for n, k in ((8, 4), (20, 40), (31, 9), (40, 200))}
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randrange(1, 5)):
            t = rng.choice(list(templates.values())).split()
            for _ in range(rng.randrange(0, 5)):
                at = rng.randrange(len(t))
                t = rng.choice((t[:at] + ["x"] + t[at:], t[:at] + t[at + 1 :], t[at:] + t[:at]))
            words += t + ["y", "z"][: rng.randrange(3)]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for tenths in (5, 7, 9):
        more = 0
        for r in license.scan(docs, templates=templates, tenths=tenths).collect():
            text = texts[r["doc_id"]]
            want, left = all_licences(text, templates, tenths)
            assert left == 0 and (r["n_matches"], r["licenses"], r["best_dice"]) == (len(want), ",".join(sorted({list(templates)[x[3]] for x in want})), max((x[2] for x in want), default=0)), r["doc_id"]
            more += tenths == 9 and len(want) > len(brute_licences(text, templates))
        assert tenths != 9 or more > 5


# --- personal data -----------------------------------------------------------------------------

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (13 <= len(d) <= 19 and pii.luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_personal_data(spark, rows, empty):
    r = np.random.default_rng(2)
    made = ["".join(r.choice(list("a1234567890.@+-() \né"), 60)) for _ in range(1500)] + ["1.2.3.4.5.6.7.8 300.1.1.1 +1 (2) 3-45678901 4111 1111 1111 1111 a@b.c.d@e.f", "9" * 50000, "a" * 50000 + "@"]
    texts = [x["text"] for x in rows] + ODD + made
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x for x in pii.find(frame).collect()}
    for i, t in enumerate(texts):
        want = plain_spans(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, want)
        assert [got[i][f"n_{k}"] for k in PLAIN] == [sum(s.startswith(k) for s in want) for k in PLAIN]
        assert set(want) <= set(got[i]["spans"].split(",")) | {""}
    assert pii.find(empty).count() == 0


def test_personal_data_model_finds_more():
    model = pii.train()
    unseen = pii.labelled_rows(300, 99)
    hits = total = extra = 0
    for (_, spans), (_, every) in zip(unseen, pii.spans_of([t for t, _ in unseen], model)):
        found = {(pii.KINDS[k], a, b) for k, a, b in every}
        hits, total, extra = hits + len(found & set(spans)), total + len(spans), extra + len(found - set(spans))
    assert hits > 0.97 * total and extra < 0.03 * total
    text = "write to ann.lee [at] mail3 [dot] example.com or call 555-123-4567 now"
    (_, every), = pii.spans_of([text], model)
    assert pii.redacted(text, every) == "write to <EMAIL> or call <PHONE> now"


@pytest.mark.parametrize("n", [5, 30, 50, 80, 400])
def test_personal_data_of_any_length(n):
    """Long local parts, domains and words around them are read to their ends, and spans are where the short form has them."""
    r = np.random.default_rng(n)
    model, name = pii.train(), "".join(r.choice(list("abcdefghij"), n))
    for text, start, stop in ((f"write to {name} [at] mail.com now", 9, 23 + n), (f"write to ann [at] {name}.com now", 9, 22 + n), (f"write to ann [at] {name} [dot] com now", 9, 28 + n), (f"{name} " * 3 + "call 555-123-4567 now", 3 * n + 8, 3 * n + 20)):
        (_, every), = pii.spans_of([text], model)
        assert [s[1:] for s in every] == [(start, stop)], text


def test_shapes_of_whole_tokens():
    assert pii.shape("a" * 40 + "1") == "x+d" and pii.shape("a" * 23 + "1") == "x+d" and pii.shape("aB1") == "xXd" and pii.shape("at") == "w:at"


def test_stretches_are_linear_and_whole():
    blob = "a1" * 300_000
    assert pii.stretches(blob) == [(0, len(blob))] and pii.stretches("x\n" + blob + "\ny") == [(2, 2 + len(blob))]
    assert pii.stretches("no trigger here") == []


def test_viterbi_is_the_best_path():
    """The decoded labels have the largest sum over all label sequences."""
    from itertools import product

    r = np.random.default_rng(4)
    shapes = {"": 0, "|": 1, "a": 2, "b": 3}
    k = len(pii.LABELS)
    model = pii.Model(shapes, r.standard_normal((5, 4, k)), r.standard_normal((k, k)), r.standard_normal(k))
    sequences = [list(r.choice(["a", "b", "c"], n)) for n in (1, 2, 3, 4, 4, 3)]
    for cells in (1 << 18, 3):
        for own, labels in zip(sequences, model.decode(sequences, cells)):
            ids = np.array([shapes.get(s, 0) for s in own])
            wide = np.pad(ids, 2, constant_values=1)
            emit = np.array([sum(model.emit[o][wide[t + o]] for o in range(5)) for t in range(len(own))])
            total = lambda y: model.first[y[0]] + emit[range(len(y)), list(y)].sum() + sum(model.moves[a, b] for a, b in zip(y, y[1:]))  # noqa: B023,E731
            assert total(tuple(labels)) == pytest.approx(max(total(y) for y in product(range(k), repeat=len(own))))


def test_personal_data_in_other_prose():
    """Sentences that the rule which makes the training table did not write."""
    model = pii.train()
    found = {
        "Please mail Jane Doe at jane_doe (at) university (dot) edu before Friday.": ["jane_doe (at) university (dot) edu"],
        "Our new office line is (212) 555-0147, ask for Tim.": ["(212) 555-0147"],
        "card no. 4111.1111.1111.1111 expired in 05/27": ["4111.1111.1111.1111"],
    }
    for text, want in found.items():
        (_, every), = pii.spans_of([text], model)
        assert [text[a:b] for _, a, b in every] == want
    for text in ("We met at noon on 12 May 2021 and paid 1,250.00 dollars.", "See chapter 3.2.1, pages 110-119, table 4.", "The dot on the map is at 45 degrees north."):
        assert pii.spans_of([text], model)[0][1] == []


def test_redaction_keeps_columns(spark, odd):
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count()


# --- mixing ------------------------------------------------------------------------------------


def test_mixing(spark, documents, odd, empty):
    n = documents.count()
    got = mixing.replicate(documents, {"src0": 3, "src1": 1}, total=20 * n, seed=4)
    by = {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}
    assert set(by) == {"src0", "src1"} and abs(by["src0"] - 15 * n) < 5 * math.sqrt(15 * n * 20) and abs(by["src1"] - 5 * n) < 5 * math.sqrt(5 * n * 20)
    assert sorted(map(tuple, got.select("doc_id", "copy").collect())) == sorted(map(tuple, mixing.replicate(documents, {"src0": 3, "src1": 1}, total=20 * n, seed=4).select("doc_id", "copy").collect()))
    assert mixing.replicate(empty).count() == 0 and set(odd.columns) <= set(mixing.replicate(odd).columns)


def test_mixing_clashing_columns(spark):
    """The operator's own columns replace those of the input; others stay as they are."""
    docs = spark.createDataFrame([(i, "t", f"s{i % 2}", 9.0, 9, 9, 9, "keep") for i in range(200)], "doc_id long, text string, source string, rate double, n_copies long, copy long, order_key long, __source string")
    got = mixing.replicate(docs, {"s0": 1, "s1": 1}, total=400)
    assert sorted(got.columns) == sorted(docs.columns)
    rows = got.collect()
    assert {r["__source"] for r in rows} == {"keep"} and {r["rate"] for r in rows} == {2.0} and all(1 <= r["copy"] <= r["n_copies"] for r in rows)


def test_poisson_quantile(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(m, u) for m in (0.3, 1.0, 4.5, 16.0) for u in (0.001, 0.3, 0.5, 0.9, 0.9999)], "m double, u double")
    for r in frame.withColumn("k", mixing.poisson_quantile(F.col("u"), F.col("m"))).collect():
        cdf, k = math.exp(-r["m"]), 0
        while r["u"] >= cdf:
            k += 1
            cdf += math.exp(-r["m"]) * r["m"] ** k / math.factorial(k)
        assert r["k"] == k


# --- vectors -----------------------------------------------------------------------------------


def brute_vectors(ids, x, cosine=0.95):
    ok = np.array([v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v) for v in x])
    n = len(ids)
    links = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(x[i]) == len(x[j]):
                a, b = np.array(x[i], float), np.array(x[j], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                links[i, j] = links[j, i] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine
    root = np.array(ids)
    for _ in range(n):
        new = np.array([min([root[i], *root[links[i]]]) for i in range(n)])
        if (new == root).all():
            break
        root = new
    return {int(ids[i]): (int(links[i].sum()), int(root[i]), bool(ids[i] == root[i])) for i in range(n)}


def as_result(frame):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in frame.collect()}


def test_vectors(spark, monkeypatch):
    data = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    assert as_result(queries.op10_embeddings(spark, SF)) == brute_vectors([r["vec_id"] for r in data], [r["embedding"] for r in data])
    r = np.random.default_rng(8)
    base = r.standard_normal((6, 40))
    x = [(base[k % 6] + r.standard_normal(40) * 0.16).tolist() for k in range(150)]
    x += [x[0], [-c for c in x[0]], [c * 1e-30 for c in x[1]], None, [], [0.0] * 40, [float("nan")] * 40, [None] + [1.0] * 39, [1.0, 2.0], [2.0, 4.0], [float("inf")] + [0.0] * 39]
    frame = spark.createDataFrame([(i, v, "z") for i, v in enumerate(x)], "vec_id long, embedding array<double>, id string")
    for lot, step in ((8192, 2048), (40, 16), (7, 3)):
        monkeypatch.setattr(vectors, "LOT", lot)
        monkeypatch.setattr(vectors, "STEP", step)
        got = as_result(vectors.near_duplicates(frame))
        assert got == brute_vectors(list(range(len(x))), x)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_vectors_at_the_boundary(spark, monkeypatch):
    """Pairs within rounding of the threshold are judged by the cosine of the vectors as they came; keys may be texts or null."""
    r = np.random.default_rng(5)
    x = []
    for _ in range(40):
        a, b = r.standard_normal((2, 32))
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        for off in (-1e-15, 0.0, 1e-15):
            x += [(a * 3).tolist(), ((a * (0.95 + off) + b * math.sqrt(1 - (0.95 + off) ** 2)) * 7).tolist()]
    frame = spark.createDataFrame([(f"k{i:04d}", v) for i, v in enumerate(x)], "vec_id string, embedding array<double>")
    n = len(x)
    data = np.array(x)
    cosine = np.array([[(data[i] * data[j]).sum() / (math.sqrt((data[i] ** 2).sum()) * math.sqrt((data[j] ** 2).sum())) for j in range(n)] for i in range(n)])
    links = (cosine >= 0.95).sum(1) - 1
    monkeypatch.setattr(vectors, "LOT", 50)
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(frame).collect()}
    sure = [i for i in range(n) if (np.abs(cosine[i] - 0.95) > 4e-16).all()]
    assert all(got[f"k{i:04d}"] == links[i] for i in sure) and len(sure) > 20
    nulls = vectors.near_duplicates(spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.01]), ("b", [1.0, 0.02]), (None, None)], "vec_id string, embedding array<float>")).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in nulls) == [("None", 0, "None"), ("None", 2, "b"), ("None", 2, "b"), ("b", 2, "b")]


def test_grid_grows_with_the_table():
    assert [vectors.grid_for(n, 64, 0.95) for n in (100, 10**5, 10**6, 10**8)] == [0, 3, 4, 4] and vectors.grid_for(10**9, 768, 0.95) == 2
