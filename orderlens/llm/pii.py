"""Operator 9, personal data (native).

Patterns propose spans, checksums confirm them (Luhn for cards, mod 97 for
account codes, the range of address parts, the digits of phone numbers), and
words near a span raise or lower its score.  Row-local: no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import spans as S
from orderlens.llm.common import table

#: Kinds in their order with the pattern of the contract (the oracle's form).
BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Countries by the length of their account codes.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}


def _iban(countries: str, length: int) -> str:
    """Codes of some countries: two check digits, groups of four, the rest."""
    groups, rest = divmod(length - 4, 4)
    tail = f"[\\x20]?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"({'|'.join(countries.split())})[0-9][0-9]([\\x20]?[A-Z0-9][A-Z0-9][A-Z0-9][A-Z0-9]){{{groups}}}{tail}"


#: Account codes; what follows a whole code is none of its business.
IBAN_PATTERN = "(" + "|".join(_iban(c, n) for n, c in IBAN_LENGTHS.items()) + ")"

#: The same matches without backtracking over long runs: possessive loops, and
#: no second start inside a run whose first start failed (``\G`` allows the one
#: after a match).  A card shorter than 16 digits cannot pass its check.
JVM_PATTERNS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9]){15,}+", None),
    "phone": (BASE_PATTERNS["phone"], "+"),
    # two letters and two digits before any country is tried
    "iban": (f"(?=[A-Z][A-Z][0-9][0-9]){IBAN_PATTERN}", None),
}
KINDS = ("email", "ip", "card", "phone", "iban")

#: Score of a confirmed span, points for a nearby word, and the nearby words.
SCORES = {"email": 80, "ip": 60, "card": 80, "phone": 60, "iban": 80}
NEAR_POINTS, FAR_POINTS = 20, 30
CONTEXT_CHARS = 40
NEAR_WORDS = "contact|mail|call|phone|tel|card|visa|pay|account|iban|bank|address|host|server|login"
FAR_WORDS = "example|sample|dummy|version|release|test"
MIN_SCORE = 60


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(match, r"\."), lambda p: (F.length(part(p)) <= 3)
                        & (F.coalesce(F.substring(part(p), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        n = S.digits(match)
        return F.when(F.length(n).between(16, 19), S.luhn(n)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(S.digits(match)).between(8, 15)
    if kind == "iban":
        code = F.regexp_replace(match, " ", "")
        return F.length(code).between(15, 34) & S.mod97(code)
    return F.lit(True)


def _confirmed(kind: str) -> Column:
    """Spans of a kind that pass its check, with their scores."""
    def scored(s: Column) -> Column:
        before = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
        near = F.lower(F.col("_t").substr(before + 1, s["start"] - before))
        score = (F.lit(SCORES[kind]) + F.when(near.rlike(NEAR_WORDS), NEAR_POINTS).otherwise(0)
                 - F.when(near.rlike(FAR_WORDS), FAR_POINTS).otherwise(0))
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        score.alias("score"))

    found = S.located("_t", kind, JVM_PATTERNS[kind][0])
    return F.transform(F.filter(found, lambda s: _valid(kind, s["match"])), scored)


def find_pii(docs: DataFrame) -> DataFrame:
    """Personal data of every text of ``docs`` (doc_id, text), a row per row.

    NULL text counts as empty: no spans, zero counts, the checksum of the empty
    string.  Repeated rows are scanned each.  An empty table gives none.  Other
    columns of ``docs`` are ignored.  Long texts are scanned whole; the patterns
    never recurse over a long run.

    n_<kind> counts spans, base_sha256 covers the four base kinds, ``spans``
    holds all of them, n_confirmed counts those whose score reaches the bar and
    max_score is the best one (0 without spans)."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    rows = S.with_matches(rows, "_t", JVM_PATTERNS)
    rows = rows.select("doc_id", *[_confirmed(kind).alias(f"_s_{kind}") for kind in KINDS])
    base = F.concat(*[F.col(f"_s_{k}") for k in KINDS[:4]])
    every = F.concat(*[F.col(f"_s_{k}") for k in KINDS])
    return rows.select(
        "doc_id", *[F.size(f"_s_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(S.span_text(base), 256).alias("base_sha256"), S.span_text(every).alias("spans"),
        F.size(F.filter(every, lambda s: s["score"] >= MIN_SCORE)).cast("long").alias("n_confirmed"),
        F.coalesce(F.array_max(F.transform(every, lambda s: s["score"])), F.lit(0)).cast("long").alias("max_score"))


def op9_find_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``find_pii`` over the whole documents table (NULL text: empty; repeated rows
    are listed each; an empty table gives none; other columns are ignored)."""
    return find_pii(table(spark, sf_dir, "documents"))


def _sql() -> str:
    luhn = ("list_sum(list_transform(range(1, length({n}) + 1), lambda j: CASE WHEN j % 2 = 0 THEN "
            "CASE WHEN 2 * reverse({n})[j]::INT > 9 THEN 2 * reverse({n})[j]::INT - 9 ELSE 2 * reverse({n})[j]::INT END "
            "ELSE reverse({n})[j]::INT END)) % 10 = 0")
    number = "regexp_replace(s.match, '[^0-9]', '', 'g')"
    code = "replace(s.match, ' ', '')"
    valid = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(s.match, '.'), lambda p: length(ltrim(p, '0')) <= 3 "
              "AND coalesce(try_cast(left(ltrim(p, '0'), 3) AS INT), 0) <= 255))",
        "card": f"length({number}) BETWEEN 16 AND 19 AND {luhn.format(n=number)}",
        "phone": f"length({number}) BETWEEN 8 AND 15",
        "iban": f"length({code}) BETWEEN 15 AND 34 AND (list_reduce(list_prepend(0::BIGINT, list_transform(string_split("
                f"substr({code}, 5) || left({code}, 4), ''), lambda c: (CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 "
                f"ELSE ascii(c) - 55 END)::BIGINT)), lambda a, v: (a * (CASE WHEN v > 9 THEN 100 ELSE 10 END) + v) % 97)) = 1",
    }
    patterns = BASE_PATTERNS | {"iban": IBAN_PATTERN}
    near = f"lower(substr(t, greatest(s.start - {CONTEXT_CHARS}, 0) + 1, least(s.start, {CONTEXT_CHARS})))"
    score = (lambda k: f"{SCORES[k]} + CASE WHEN regexp_matches({near}, '{NEAR_WORDS}') THEN {NEAR_POINTS} ELSE 0 END "
             f"- CASE WHEN regexp_matches({near}, '{FAR_WORDS}') THEN {FAR_POINTS} ELSE 0 END")
    lists = ",\n  ".join(
        f"list_transform(list_filter({S.sql_spans(k, f'm_{k}', f'g_{k}')}, lambda s: {valid[k]}), lambda s: "
        f"{{'label': '{k}:' || s.start || ':' || (s.start + length(s.match)), 'score': {score(k)}}}) AS s_{k}"
        for k in KINDS)
    counts = ", ".join(f"len(s_{k})::BIGINT AS n_{k}" for k in KINDS)
    base = "list_concat(list_concat(s_email, s_ip), list_concat(s_card, s_phone))"
    text = lambda spans: f"coalesce(array_to_string(list_transform({spans}, lambda s: s.label), ','), '')"
    every = f"list_concat({base}, s_iban)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id,
  {lists}
FROM (SELECT *, {S.sql_found(patterns, "t")} FROM d))
SELECT doc_id, {counts}, sha256({text(base)}) AS base_sha256, {text(every)} AS spans,
  len(list_filter({every}, lambda s: s.score >= {MIN_SCORE}))::BIGINT AS n_confirmed,
  coalesce(list_max(list_transform({every}, lambda s: s.score)), 0)::BIGINT AS max_score
FROM s
"""


QUERIES = {"op9_find_pii": op9_find_pii}
ORACLES = {"op9_find_pii": _sql()}
