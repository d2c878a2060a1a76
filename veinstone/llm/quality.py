"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule is a predicate over a text and its words that rejects the text. On a sample the planner
measures what each rule costs beyond splitting the text into words, and which texts it rejects, and
orders the rules by rejection per cost, each among the texts that those before it let through. The
verdict is one CASE whose later branches, with all that they count, are evaluated only for texts
that the earlier ones let through; the words are split once. The order decides the time, never the
verdict, which is "no rule rejects": it is the same for every order.

Defined results: a null text has no words and is rejected by the length rule, as is an empty
one; ties in rejection per cost fall back to the rule's name; repeated rows are judged each on
their own; an empty table gives an empty result (the declared order stands); other columns
of the input, whatever their names, are carried through by `filter_documents` and ignored by
`judged`.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinstone.llm.common import SPACE, bind, discard, words_of, written

SYMBOLS = "#*$%&|<>"
WINDOW = 5


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), SPACE, "")).cast("long")


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.translate(s, SPACE, "") != "")


def lines(text: Column) -> Column:
    """struct(n, dup): lines that hold a word, and those equal to an earlier one."""
    return bind(lines_of(text), lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))


def n_repeat_words(words: Column, n: int = WINDOW) -> Column:
    """Words that lie in an n-word window found twice or more.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes; only texts in which two
    windows agree take the sort that finds where.
    """

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.coalesce(F.least(F.lit(n), F.get(at, k + 1) - p), F.lit(n)).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        same = F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)))
        return bind(F.sort_array(F.transform(same, lambda x: x["i"])), covered)

    def count(h: Column) -> Column:
        sort = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(bind(sort, repeated))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return bind(hashed, lambda w: F.when(F.size(w) <= n, F.lit(0).cast("long")).otherwise(bind(windows(w), count)))


@dataclass(frozen=True)
class Measures:
    """What rules look at. Where a measure is not given, it is an expression that is evaluated in the branch that needs it."""

    text: Column
    words: Column
    given: dict[str, Column] = field(default_factory=dict)

    def __getattr__(self, name: str) -> Column:
        makers = {"n_words": lambda: n_words(self.words), "n_repeat_words": lambda: n_repeat_words(self.words), "word_chars": lambda: word_chars(self.text), "n_symbols": lambda: n_symbols(self.text), "lines": lambda: lines(self.text), "n_letters": lambda: n_letters(self.text)}
        if name not in makers:
            raise AttributeError(name)
        return self.given[name] if name in self.given else makers[name]()


@dataclass(frozen=True)
class Rule:
    """rejects: of the measures of a text (not null), true for a text to be rejected; sql: the same for DuckDB over measures by name."""

    name: str
    rejects: Callable[[Measures], Column]
    sql: str


def n_words(words: Column) -> Column:
    return F.size(words).cast("long")


def n_letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{L}+", ""))


#: Rules that the base of op3 states itself; thresholds as integers, so that every engine agrees.
BASE_RULES = (
    Rule("too_short", lambda m: m.n_words < 10, "n_words < 10"),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 20 * m.n_words, "100 * n_repeat_words > 20 * n_words"),
)
#: Rules that only the cascade has.
OWN_RULES = (
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words, "10 * n_symbols > n_words"),
    Rule("word_length", lambda m: bind(m.word_chars, lambda c: (c < 2 * m.n_words) | (c > 15 * m.n_words)), "(word_chars < 2 * n_words or word_chars > 15 * n_words)"),
    Rule("duplicate_lines", lambda m: bind(m.lines, lambda x: 2 * x["dup"] > x["n"]), "2 * n_dup_lines > n_lines"),
    Rule("few_letters", lambda m: 2 * m.n_letters < m.word_chars, "2 * n_letters < word_chars"),
)
RULES = BASE_RULES + OWN_RULES

#: Rows of the sample, on the average, and the most characters of each: longer texts are judged like all, but not used for planning.
SAMPLE_ROWS, SAMPLE_CHARS = 512, 1 << 16
#: Times that a rule is timed, and copies of the sample in each.
TIMES, COPIES = 2, 2


@dataclass(frozen=True)
class Estimate:
    """seconds: of one pass over the sample, words given; rejected: share of the texts that the rules before it let through."""

    name: str
    seconds: float
    rejected: float


def by_worth(rules: tuple[Rule, ...], seconds: dict[str, float], patterns: dict[int, int]) -> tuple[tuple[Rule, ...], list[Estimate]]:
    """The rule of the most rejection per cost among what is left, again and again. patterns: rows by the set of rules that reject them, as bits in the order of rules."""
    left, out, estimates = list(range(len(rules))), [], []
    while left:
        alive = sum(n for p, n in patterns.items())
        share = {k: sum(n for p, n in patterns.items() if p >> k & 1) / max(alive, 1) for k in left}
        best = min(left, key=lambda k: (-share[k] / max(seconds[rules[k].name], 1e-6), rules[k].name))
        left.remove(best)
        out.append(rules[best])
        estimates.append(Estimate(rules[best].name, seconds[rules[best].name], share[best]))
        patterns = {p: n for p, n in patterns.items() if not p >> best & 1}
    return tuple(out), estimates


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 1) -> tuple[tuple[Rule, ...], list[Estimate]]:
    """rules in the order of rejection per cost on a sample of about sample_rows rows from all over docs, and the estimates.

    A rule's cost is the time of a job that applies it, less that of the same job without a rule,
    which splits the words; the quickest of TIMES runs counts.
    """
    rows = docs.count()
    if not rows:
        return rules, []
    some = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).sample(False, min(1.0, sample_rows / rows), seed)
    sample = written(some.where(F.length("text") <= SAMPLE_CHARS).repartition(1), "rule-sample")
    t = F.col("text")
    verdicts = [lambda m, r=r: F.coalesce(r.rejects(m), F.lit(True)) for r in rules]
    bits = bind(words_of(t), lambda w: sum((v(Measures(t, w)).cast("int") * (1 << k) for k, v in enumerate(verdicts)), F.lit(0)))
    patterns = {r["p"]: r["n"] for r in sample.groupBy(bits.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}  # as many rows as sets of rules at most

    def timed(verdict: Callable[[Measures], Column]) -> float:
        job = sample.select(F.explode(F.array_repeat("text", COPIES)).alias("text")).agg(F.count_if(bind(words_of(t), lambda w: verdict(Measures(t, w)))))
        took = []
        for _ in range(TIMES):
            began = time.perf_counter()
            job.first()
            took.append(time.perf_counter() - began)
        return min(took) / COPIES

    without = timed(lambda m: m.n_words < 0)
    seconds = {r.name: max(timed(v) - without, 1e-4) for r, v in zip(rules, verdicts)}
    discard(sample)
    return by_worth(rules, seconds, patterns)


def first_rejection(measures: Measures, rules: tuple[Rule, ...]) -> Column:
    """The first rule, in the order given, that rejects the text; null if none does."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.rejects(measures), F.lit(True)), F.lit(rule.name)).otherwise(verdict)
    return verdict


def rejection(text: Column, rules: tuple[Rule, ...]) -> Column:
    """The same of a text that may be null, its words split once."""
    text = F.coalesce(text, F.lit(""))
    return bind(words_of(text), lambda w: first_rejection(Measures(text, w), rules))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = OWN_RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the base's measures, base_failed, and kept: not base_failed and rejected by none of rules.

    The base's measures are counted for every text, as they are asked for; what the rules count
    beside them, only for texts that come to that rule.
    """
    t = F.coalesce(F.col("_text"), F.lit(""))

    def verdict(words: Column) -> Column:
        n = n_words(words)

        def given(repeats: Column) -> Column:
            measures = Measures(t, words, {"n_repeat_words": repeats, **{c: F.col(f"_{c}") for c in ("word_chars", "n_symbols", "lines")}})
            failed = (n < 10) | (100 * repeats > 20 * n)
            return F.struct(n.alias("n_words"), repeats.alias("n_repeat_words"), failed.alias("base_failed"), F.when(failed, False).otherwise(first_rejection(measures, rules).isNull()).alias("kept"))

        return bind(n_repeat_words(words), given)

    measured = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).select("_key", "_text", word_chars(t).alias("_word_chars"), n_symbols(t).alias("_n_symbols"), lines(t).alias("_lines"))
    return measured.select("*", bind(words_of(t), verdict).alias("v")).select(
        F.col("_key").alias(key), "v.n_words", F.col("_word_chars").alias("word_chars"), F.col("_n_symbols").alias("n_symbols"), F.col("_lines.dup").alias("n_dup_lines"), "v.n_repeat_words", "v.base_failed", "v.kept"
    )


def filter_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """docs without the rejected ones; all columns stay."""
    ordered, _ = plan(docs, rules, text)
    return docs.where(rejection(F.col(text), ordered).isNull())
