"""Mixing of sources to target weights by Poisson replication.

A source with target share w of T rows out of its n rows has mean repetition rate w·T/n. Each
document's count is the Poisson quantile, for that mean, of a uniform number hashed from seed
and document key; the document is repeated that often, and the copies are dealt to partitions
and ordered by a hash of (seed, key, copy): a global shuffle that any task can repeat exactly,
so a lost executor's part is recomputed as it was. A mean above PART is split into equal parts
whose independent counts are added, which keeps exp(-mean) in range.

The rates are one small row per source. Up to BROADCAST_SOURCES of them, which is checked, they
are broadcast, so that texts move once; more are joined by a shuffle with skew splitting.

Defined results: a null source is a source of its own, with a weight under the key None; a
source without a weight gets none of its documents; null or empty texts count as documents;
rows with equal keys get equal counts; an empty table gives an empty result; other columns are
kept, and the operator's own columns replace input columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinstone.llm.common import bind, fresh, written

#: The largest mean that is inverted in one piece.
PART = 16.0
#: Terms of the distribution that are summed: for means up to PART the rest is below 1e-13, less than the hash resolves.
TERMS = 72


#: Sources whose rates are broadcast: a few MB.
BROADCAST_SOURCES = 50_000


def hashed_uniform(*parts: Column) -> Column:
    """Uniform in (0, 1) from the first 48 bits of the parts' MD5."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def poisson_quantile(u: Column, mean: Column) -> Column:
    """The number of k with P(count <= k) <= u."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0).alias("n"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.when(u < s["cdf"], s).otherwise(F.struct(p.alias("p"), (s["cdf"] + p).alias("cdf"), (s["n"] + 1).alias("n")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step)["n"]


def counts(docs: DataFrame, rates: DataFrame, seed: int = 0, key: str = "doc_id", source: str = "source") -> DataFrame:
    """docs with rate (mean repetition rate) and n_copies."""
    (own,) = fresh(docs, "source")
    rates = rates.select(F.col("source").alias(own), F.col("rate"))
    joined = docs.drop("rate", "n_copies").join(rates, F.col(source).eqNullSafe(F.col(own)), "left").drop(own)
    rate = F.coalesce(F.col("rate"), F.lit(0.0))
    parts = F.greatest(F.ceil(rate / PART), F.lit(1)).cast("int")
    one = lambda i: bind(hashed_uniform(F.lit(seed), F.col(key), i), lambda u: poisson_quantile(u, rate / parts))
    total = F.aggregate(F.transform(F.sequence(F.lit(1), parts), one), F.lit(0).cast("long"), lambda a, x: a + x)
    return joined.withColumn("rate", rate).withColumn("n_copies", F.when(rate <= 0, F.lit(0).cast("long")).otherwise(total))


def rates_for(docs: DataFrame, weights: dict | None = None, exponent: float = 0.5, total: float | None = None, source: str = "source") -> DataFrame:
    """(source, n_docs, weight, rate) for target weights by source; without weights, shares in proportion to n_docs ** exponent.

    total: expected rows of the result; as many as docs has if not given.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        sizes = sizes.withColumn("_w", F.pow(F.col("n_docs").cast("double"), F.lit(float(exponent))))
    else:
        own = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "_s string, _w double")
        sizes = sizes.join(own, sizes["source"].eqNullSafe(own["_s"]), "left").drop("_s").withColumn("_w", F.coalesce("_w", F.lit(0.0)))
    sums = sizes.agg(F.sum("n_docs").alias("_n"), F.sum("_w").alias("_total"))
    target = F.lit(float(total)) if total is not None else F.col("_n").cast("double")
    # one row of totals beside the sources
    return sizes.join(F.broadcast(sums)).select("source", "n_docs", (F.col("_w") / F.col("_total")).alias("weight"), (F.col("_w") / F.col("_total") * target / F.col("n_docs")).alias("rate"))


def replicate(docs: DataFrame, weights: dict | None = None, exponent: float = 0.5, total: float | None = None, seed: int = 0, key: str = "doc_id", source: str = "source") -> DataFrame:
    """docs repeated by their counts, with copy (from 1) and order_key, shuffled globally by order_key."""
    rates = written(rates_for(docs, weights, exponent, total, source), "rates")
    counted = counts(docs, F.broadcast(rates) if rates.count() <= BROADCAST_SOURCES else rates, seed, key, source)
    copies = counted.where("n_copies > 0").drop("copy", "order_key").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    keyed = copies.withColumn("order_key", F.xxhash64(F.lit(seed), F.col(key), F.col("copy")))
    return keyed.repartition("order_key").sortWithinPartitions("order_key")


def duckdb_sql(exponent: float = 0.5, seed: int = 0) -> str:
    """(doc_id, source, rate, n_copies) for means up to PART, as a list of Poisson terms."""
    fact = [math.factorial(k) for k in range(40)]
    terms = ", ".join(f"{float(f)!r}" for f in fact)
    return f"""
with sizes as (select source, count(*) as n_docs, pow(count(*)::double, {exponent!r}) as w from documents group by source),
rates as (select source, w / (select sum(w) from sizes) * (select sum(n_docs) from sizes)::double / n_docs as rate from sizes),
seeded as (select d.doc_id, d.source, r.rate, (('0x' || substr(md5('{seed}:' || d.doc_id || ':1'), 1, 12))::bigint::double + 0.5) / 281474976710656.0 as u
  from documents d join rates r on d.source is not distinct from r.source),
cdf as (select source, k, sum(exp(-rate) * pow(rate, k) / ([{terms}])[k + 1]) over (partition by source order by k) as p from rates, range(40) t(k))
select s.doc_id, s.source, round(s.rate, 9) as rate, (select count(*) from cdf c where c.source is not distinct from s.source and c.p <= s.u) as n_copies from seeded s"""
