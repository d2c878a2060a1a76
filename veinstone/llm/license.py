"""Licence notices and texts by Dice coefficient over word bigrams, in DataFrame expressions only.

A text is normalised (lower case, runs of anything but ASCII letters and digits to one blank), so
that a notice that is wrapped into lines, indented or put in comments is one run of words again. A
template of m bigrams, with the set B of them, is compared with windows of m bigrams of the text.
With the window's set A the template matches if 2|A∩B| / (|A|+|B|) >= threshold. Windows at whose
places at least a third of B would stand where the template has it come first. Of the others, which
are all counted, those that have more than a quarter of their places in common with a match are
another view of it; from left to right, the first that is not and those that have as much in common
with it are one place, whose best window (the first of equals) is a match. So every window that
reaches the threshold is a match or another view of one. A match that lies within a larger one, or in
the place of a better one, does not count. (`duckdb_sql` has the windows of the first kind only.)

All windows are counted by sorts, and only in texts that have enough of a template's bigrams close
together outside the matches found before.

The coefficient t needs |A∩B| >= t/(2-t)·|B|, so a text can only match templates of at most so many
bigrams as it has hits among all templates' bigrams: most texts are done after one look at each of
their bigrams, and larger templates are pruned by their size. Bigrams are compared by 64-bit hashes.
Templates are constants of the plan: no join, no broadcast, nothing that grows.

Defined results: null, empty and one-word texts match nothing; equal coefficients go to the
template listed first; repeated rows are scanned each on their own; an empty table gives an
empty result; only the key and the text of the input are read, whatever other columns are called.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinstone.llm.common import bind

#: Common licence notices, by identifier.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
#: Of 10: matches need a coefficient of 9/10. Short notices that differ in one word (version 2, version 3) stay apart.
THRESHOLD_TENTHS = 9


@cache
def templates_of(folder: str = str(Path(__file__).with_name("licences"))) -> dict[str, str]:
    """The notices, and the whole texts in a folder by file name: those of this package if none is given."""
    return NOTICES | {p.stem + "-text": p.read_text() for p in sorted(Path(folder).glob("*.txt"))}


def normal_words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams_of(text: str) -> list[tuple[str, str]]:
    """Each word with the next, in order."""
    words = normal_words(text)
    return list(zip(words, words[1:]))


def spark_hash(*parts: str) -> int:
    """F.xxhash64 of strings."""
    h = 42
    for part in parts:
        h = xxhash.xxh64_intdigest(part.encode(), h)
    return h - (h >> 63 << 64)


def bigrams(text: Column) -> Column:
    """The hash of each word with the next."""
    words = F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "), " "), lambda w: w != "")
    return bind(words, lambda w: F.when(F.size(w) < 2, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)))))


def longs(values: list[int]) -> Column:
    """A constant array."""
    return F.expr(f"cast(split('{','.join(map(str, values))}', ',') as array<bigint>)")


def up_to(values: Column, n: Column) -> Column:
    """For each a from 0 to n - 1 how many of the values (none below 0) are at most a, by one sort."""
    marks = F.transform(F.sequence(F.lit(0), n - 1), lambda a: 2 * a + 1)
    return bind(F.sort_array(F.concat(F.transform(values, lambda v: 2 * v), marks)), lambda both: F.filter(F.transform(both, lambda x, j: F.when(x % 2 == 1, j - F.shiftright(x, 1))), lambda x: x.isNotNull()))


def distinct_counts(grams: Column, at: Column, m: Column) -> Column:
    """For each place how many different bigrams stand at the places `at` (ascending) among the m from there on.

    An occurrence counts in the windows that start behind the same bigram's last one before it and not behind itself.
    """
    seen = F.sort_array(F.transform(at, lambda i: F.struct(F.get(grams, i).alias("gram"), i.alias("i"))))
    before = lambda seen, x, j: F.when(F.get(seen, j - 1)["gram"] == x["gram"], F.get(seen, j - 1)["i"] + 1)
    since = bind(seen, lambda seen: F.transform(seen, lambda x, j: F.greatest(F.lit(0), x["i"] - (m - 1), before(seen, x, j))))
    return F.zip_with(up_to(since, F.size(grams)), up_to(F.transform(at, lambda i: i + 1), F.size(grams)), lambda a, b: a - b)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, tenths: int = THRESHOLD_TENTHS) -> DataFrame:
    """One row per document: n_matches (windows that match a template), licenses (their templates, distinct, sorted, comma-joined), best_dice (thousandths, floor; 0 without a match)."""
    templates = templates_of() if templates is None else templates
    known = {name: [spark_hash(*b) for b in bigrams_of(t)] for name, t in templates.items()}
    every = sorted({h for hashes in known.values() for h in hashes})
    g, p = F.col("_g"), F.col("_p")
    # |A| bounds of template size s, in integers: t|A| <= (2-t)s and ts <= (2-t)|A| with t = tenths/10
    fits = lambda n, s: (F.lit(tenths) * n <= (20 - tenths) * s) & (tenths * s <= (20 - tenths) * n)

    def match(rank: Column, m: Column, s: Column, start: Column, n: Column, k: Column) -> Column:
        """The window there, if its n bigrams, k of them the template's, reach the threshold."""
        return F.when(fits(n, s) & (20 * k >= tenths * (n + s)), F.struct(start.cast("int").alias("start"), F.least(start + m, F.size(g)).cast("int").alias("end"), F.floor(2000 * k / (n + s)).cast("long").alias("dice"), rank.alias("rank")))

    def by_votes(rank: int, hashes: list[int], hits: Column) -> Column:
        """For a template of which the text has enough bigrams: rank, sizes, the places of its bigrams in the text and the matches found by votes."""
        # the template's bigrams by place, and its set
        placed, own, m, s = longs(hashes), longs(sorted(set(hashes))), len(hashes), len(set(hashes))
        need, least = -(-s // 3), -(-tenths * s // (20 - tenths))

        def window(start: Column) -> Column:
            return bind(F.array_distinct(F.slice(g, start + 1, m)), lambda a: bind(F.size(F.array_intersect(a, own)), lambda k: match(F.lit(rank), F.lit(m), F.lit(s), start, F.size(a), k)))

        def windows(starts: Column) -> Column:
            """Of the sorted places at which the template would have to start, those with enough votes."""
            voted = F.filter(starts, lambda x, i: F.coalesce(x == F.get(starts, i + (need - 1)), F.lit(False)) & F.coalesce(x != F.get(starts, i - 1), F.lit(True)))
            return F.filter(F.transform(voted, window), lambda x: x.isNotNull())

        def found(hit: Column) -> Column:
            starts = F.array_sort(F.transform(hit, lambda x: F.greatest(x["i"] - x["k"] + 1, F.lit(0))))
            return F.struct(F.lit(rank).alias("rank"), F.lit(m).alias("m"), F.lit(s).alias("s"), F.lit(least).alias("least"), F.transform(hit, lambda x: x["i"]).alias("at"), bind(starts, windows).alias("found"))

        # the places of the template's bigrams in the text, and where in the template they first stand
        hit = F.filter(F.transform(p, lambda i: F.struct(i.alias("i"), F.array_position(placed, F.get(g, i)).cast("int").alias("k"))), lambda x: x["k"] > 0)
        enough = lambda n: (20 - tenths) * n >= tenths * s
        return F.when(enough(F.size(hits)) & enough(F.size(F.array_intersect(own, hits))), bind(hit, found))

    def everywhere(t: Column) -> Column:
        """The matches found by votes and, of all other windows that match apart from these, the best of each place."""
        at, found, m, s = t["at"], t["found"], t["m"], t["s"]
        n = F.size(g)

        def others(ranks: Column) -> Column:
            def shares(x: Column, length: Column) -> Column:
                """Whether more than a quarter of length is shared with a match found, the last that starts up to x or the first behind (others share less)."""
                with_one = lambda o: o.isNotNull() & (4 * (F.least(o["end"], x["end"]) - F.greatest(o["start"], x["start"])) > length)
                return bind(F.get(ranks, x["start"]), lambda r: with_one(F.get(found, r - 1)) | with_one(F.get(found, r)))

            def next_window(state: Column, y: Column) -> Column:
                # kept: the best window of each place; end: that of the first window in the last place
                kept, last = state["kept"], F.get(state["kept"], F.size(state["kept"]) - 1)
                before = lambda end: 4 * (end - y["start"]) > y["end"] - y["start"]
                better = F.when(y["dice"] > last["dice"], F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(y))).otherwise(kept)
                both = lambda k, e: F.struct(k.alias("kept"), e.alias("end"))
                return F.when(before(state["end"]), both(better, state["end"])).when(before(last["end"]), state).otherwise(both(F.concat(kept, F.array(y)), y["end"]))

            def all_windows(own: Column) -> Column:
                every = F.transform(distinct_counts(g, F.sequence(F.lit(0), n - 1), m), lambda c, start: match(t["rank"], m, s, start, c, F.get(own, start)))
                apart = F.filter(every, lambda x: x.isNotNull() & ~shares(x, x["end"] - x["start"]))
                start = F.struct(F.slice(found, 1, 0).alias("kept"), F.lit(-1).alias("end"))
                return F.concat(found, F.aggregate(apart, start, next_window, lambda state: state["kept"]))

            # a match holds at least `least` of the template's bigrams, so without a window of so many places apart from those found there is none
            spans = F.transform(at, lambda i, j: F.struct(i.alias("start"), (F.get(at, j + (t["least"] - 1)) + 1).alias("end")))
            close = F.exists(spans, lambda x: x["end"].isNotNull() & (x["end"] - x["start"] <= m) & ~shares(x, m))
            return F.when(close, bind(distinct_counts(g, at, m), all_windows)).otherwise(found)

        return bind(up_to(F.transform(found, lambda x: x["start"]), n), others)

    def matches(hits: Column) -> Column:
        return F.flatten(F.transform(F.array_compact(F.array(*[by_votes(r, h, hits) for r, h in enumerate(known.values()) if h])), everywhere))

    def outermost(found: Column) -> Column:
        def hidden(x: Column, o: Column) -> Column:
            larger = (o["end"] - o["start"]) > (x["end"] - x["start"])
            return (o["start"] <= x["start"]) & (o["end"] >= x["end"]) & (larger | (o["dice"] > x["dice"]) | ((o["dice"] == x["dice"]) & (o["rank"] < x["rank"])))

        return F.filter(found, lambda x: ~F.exists(found, lambda o: hidden(x, o)))

    places = f"case when size(_g) > 0 then filter(sequence(0, size(_g) - 1), i -> _g[i] in ({', '.join(f'{h}L' for h in every)})) else cast(array() as array<int>) end"
    named = docs.select(F.col(key).alias("_key"), bigrams(F.col(text)).alias("_g")).select("_key", "_g", F.expr(places).alias("_p"))
    matched = named.select("_key", bind(F.array_distinct(F.transform(p, lambda i: F.get(g, i))), lambda hits: bind(matches(hits), outermost)).alias("_m"))
    names = F.array(*[F.lit(n) for n in known])
    return matched.select(
        F.col("_key").alias(key),
        F.size("_m").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("_m", lambda x: F.get(names, x["rank"])))), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("_m", lambda x: x["dice"])), F.lit(0).cast("long")).alias("best_dice"),
    )


def duckdb_sql(docs: str = "documents", templates: dict[str, str] | None = None, tenths: int = THRESHOLD_TENTHS) -> str:
    """The same by joins of all bigrams with all templates' bigrams, without the windows that have too few votes."""
    templates = templates_of() if templates is None else templates
    rows = ", ".join(f"({i}, '{n}', '{' '.join(normal_words(t))}')" for i, (n, t) in enumerate(templates.items()))
    return f"""
with templates(rank, name, t) as (values {rows}),
tw as (select rank, name, string_split(t, ' ') as w from templates),
tg as (select rank, name, len(w) as m, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) as g from tw),
tp as (select rank, unnest(g) as gram, generate_subscripts(g, 1) as k from tg),
tb as (select rank, gram, min(k) as k from tp group by all),
ts as (select tg.rank, any_value(name) as name, any_value(m) as m, count(*) as s, list(gram) as b from tg join tb using (rank) group by 1),
dw as (select doc_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '') as w from {docs}),
dg as (select doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) as g from dw where len(w) >= 2),
dp as (select doc_id, unnest(g) as gram, generate_subscripts(g, 1) as i from dg),
votes as (select doc_id, rank, greatest(i - k, 0) as a, count(*) as n from dp join tb using (gram) group by all),
windows as (select v.doc_id, v.rank, v.a, ts.name, ts.s, ts.b, least(v.a + ts.m - 1, len(dg.g)) as e, list_distinct(list_slice(dg.g, v.a + 1, v.a + ts.m - 1)) as own
  from votes v join ts using (rank) join dg using (doc_id) where 3 * v.n >= ts.s),
scored as (select doc_id, rank, name, a, e, 2000 * len(list_intersect(own, b)) // (len(own) + s) as dice from windows where 20 * len(list_intersect(own, b)) >= {tenths} * (len(own) + s)),
kept as (select * from scored x where not exists (select 1 from scored o where o.doc_id = x.doc_id and o.a <= x.a and o.e >= x.e and (o.e - o.a > x.e - x.a or o.dice > x.dice or (o.dice = x.dice and o.rank < x.rank))))
select d.doc_id, count(k.rank) as n_matches, coalesce(string_agg(distinct k.name, ',' order by k.name), '') as licenses, coalesce(max(k.dice), 0)::bigint as best_dice
from {docs} d left join kept k on k.doc_id = d.doc_id group by d.doc_id"""
