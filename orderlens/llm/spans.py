"""Pattern spans as DataFrame expressions: matches with code-point positions.

Spark returns the matched strings of a pattern but not where they stand.  The
strings between the matches come from splitting at the same pattern, so the
k-th match starts after k+1 gaps and k matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,match:string>>"


def with_matches(rows: DataFrame, text: str, patterns: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Add ``_m_<kind>``: the leftmost non-overlapping matches of each pattern.

    The second item of a pattern is a literal that every match holds; texts
    without it skip the pattern."""
    cols = {}
    for kind, (pattern, needle) in patterns.items():
        found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
        if needle:
            found = F.when(F.col(text).contains(needle), found).otherwise(F.array().cast("array<string>"))
        cols[f"_m_{kind}"] = found
    return rows.withColumns(cols)


#: Matches that are placed together: a list grown by one item is copied, so
#: placing all of a text's matches in one list would be quadratic.
PLACED = 128


def located(text: str, kind: str, pattern: str) -> Column:
    """Spans of ``_m_<kind>``: start and end in code points, end exclusive.

    Parts of ``PLACED`` matches are measured first; each part then starts where
    the parts before it end."""
    matches = F.col(f"_m_{kind}")

    def add(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(
            F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match")))).alias("out"))

    def placed(pairs: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), F.array().cast(SPAN).alias("out"))
        return F.aggregate(pairs, start, add, lambda acc: acc["out"])

    def follow(acc: Column, part: Column) -> Column:
        size = F.aggregate(part, F.lit(0), lambda n, pair: n + F.length(pair["gap"]) + F.length(pair["match"]))
        return F.struct((acc["at"] + size).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts"))

    pairs = F.arrays_zip(F.slice(F.split(F.col(text), pattern, -1), F.lit(1), F.size(matches)).alias("gap"),
                         matches.alias("match"))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    # as the one item of an array the pairs are made once, not once a part
    parts = F.transform(F.array(pairs), lambda every: F.transform(
        F.sequence(F.lit(1), F.size(matches), F.lit(PLACED)), lambda k: F.slice(every, k, PLACED)))[0]
    starts = F.aggregate(parts, first, follow, lambda acc: acc["starts"])
    many = F.flatten(F.transform(F.arrays_zip(parts.alias("part"), starts.alias("at")),
                                 lambda x: placed(x["part"], x["at"])))
    return (F.when(F.size(matches) > PLACED, many).when(F.size(matches) > 0, placed(pairs, F.lit(0)))
            .otherwise(F.array().cast(SPAN)))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn checksum of a digit string."""
    chars = F.split(F.reverse(number), "")

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(chars, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """ISO 7064 mod 97-10 of an account code: country and check digits moved
    to the end, letters as 10..35; valid if the remainder is 1."""
    moved = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        v = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (acc * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), add) == 1


def span_text(spans: Column) -> Column:
    """``kind:start:end`` comma-joined, in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sql_found(patterns: dict[str, str], text: str) -> str:
    """DuckDB columns ``m_<kind>`` and ``g_<kind>``: matches and gaps."""
    return ", ".join(f"regexp_extract_all({text}, '{p}') AS m_{k}, string_split_regex({text}, '{p}') AS g_{k}"
                     for k, p in patterns.items())


def sql_spans(kind: str, m: str, g: str) -> str:
    """DuckDB expression of the spans of a pattern (list of structs)."""
    return (f"list_transform(range(1, len({m}) + 1), lambda i: {{'kind': '{kind}', 'match': {m}[i], "
            f"'start': (list_sum(list_transform({g}[1:i], lambda x: length(x))) "
            f"+ coalesce(list_sum(list_transform({m}[1:i - 1], lambda x: length(x))), 0))::BIGINT}})")
