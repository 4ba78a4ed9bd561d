"""Operator 7, secret scans by corpus-wide ownership (native).

A string that looks like a credential is an example if many owners have it and
a live secret if it belongs to one or two and looks random.  Patterns propose
candidates per row; the hashes of their values are counted over the corpus by
distinct repository and owner; the verdict goes back to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import spans as S
from orderlens.llm.common import doc_order, stage_table, table, text_tag, whole_rows

#: Kinds in their order: the contract's base kinds, then the added ones.
PATTERNS = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "code": r"gh[pousr]_[A-Za-z0-9]+",
    "jwt": r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
    # a private key with its body (header fields hold some dashes); without an end it is the header alone
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-[^-]+){0,8}?-----END [A-Z ]*PRIVATE KEY-----)?",
}
KINDS = tuple(PATTERNS)
BASE_KINDS = KINDS[:3]
#: The same matches, without those that are too short to pass, and the literal
#: each one holds.  A jwt is looked for once a run of its letters, whose part
#: before the token is cut off again (``_token``).
JVM_PATTERNS = {
    "assign": (PATTERNS["assign"], None),
    "access": (r"AKIA[A-Z0-9]{12,}", "AKIA"),
    "hex": (r"[0-9a-f]{32,}", None),
    "code": (r"gh[pousr]_[A-Za-z0-9]{36,}", "gh"),
    "jwt": (r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-])[A-Za-z0-9_-]*?" + PATTERNS["jwt"], "eyJ"),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-[^-]++){0,8}?-----END [A-Z ]*PRIVATE KEY-----)?", "-----BEGIN"),
}
#: A value of so many owners is a copied example; so is one of two owners that
#: lies in so many repositories.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 10
#: A live-looking value: least characters (of an assigned value, of a key's body,
#: of the rest), least different ones, none of these words, and no more than half
#: of it such filling.
LIVE_CHARS, LIVE_VARIETY = {"assign": 8, "pem": 40}, 8
OTHER_CHARS = 16
PLACEHOLDERS = "example|sample|dummy|changeme|placeholder|your"
FILLING = "0000+|xxxx+|1234567[890]*"
REDACTED = "[SECRET]"

_CANDIDATE = "array<struct<kind:string,start:int,end:int,hash:string,looks_live:boolean>>"


def _assigned(match: Column) -> Column:
    """The assigned value: what follows the keyword, separator and quote."""
    return F.regexp_extract(match, PATTERNS["assign"], 2)


def _pem_body(match: Column) -> Column:
    """Body of a key block without line breaks, written out ones too; empty without an end."""
    body = F.regexp_extract(match, r"(?s)PRIVATE KEY-----(.*)-----END ", 1)
    return F.regexp_replace(body, r"[\x20\t\n\r\f]|\\[nr]", "")


def _token(s: Column) -> Column:
    """A jwt without the letters of its run before it."""
    value = F.regexp_extract(s["match"], r"eyJ[A-Za-z0-9_-].*", 0)
    return F.struct((s["end"] - F.length(value)).alias("start"), s["end"].alias("end"), value.alias("match"))


def _candidates(kind: str) -> Column:
    """Candidates of one kind: spans that pass their length, with the hash of
    the value and whether it looks live."""
    found = S.located("_t", kind, JVM_PATTERNS[kind][0])
    if kind == "assign":
        found = F.filter(found, lambda s: F.length(_assigned(s["match"])) >= 8)
    if kind == "jwt":
        found = F.transform(found, _token)

    def candidate(s: Column) -> Column:
        value = {"assign": _assigned, "pem": _pem_body}.get(kind, lambda m: m)(s["match"])
        live = ((F.length(value) >= LIVE_CHARS.get(kind, OTHER_CHARS)) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
                & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_VARIETY))
        if kind != "pem":  # a long random body holds such short words by chance
            low = F.lower(value)
            live = live & ~low.rlike(PLACEHOLDERS) & (
                F.length(F.regexp_replace(low, FILLING, "")) * 2 >= F.length(value))
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        F.sha2(value, 256).alias("hash"), live.alias("looks_live"))

    return F.transform(found, candidate).cast(_CANDIDATE)


def _in_order(spans: Column) -> Column:
    """By start, then kind as listed."""
    place = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"),
                                                  s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def owner_of(repository: str) -> Column:
    """Owner of an ``owner/repository`` name; a name without a slash owns itself."""
    return F.substring_index(F.coalesce(F.col(repository), F.lit("")), "/", 1)


def candidates(docs: DataFrame, repository: str = "source") -> DataFrame:
    """A row for every row of ``docs`` with its candidate spans (no text):
    written to a stage table, as it is read for the counts and the verdicts."""
    rows = docs.select("doc_id", doc_order().alias("_o"), text_tag().alias("_tag"),
                       F.coalesce(F.col(repository), F.lit("")).alias("_repo"), owner_of(repository).alias("_owner"),
                       F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    rows = S.with_matches(rows, "_t", JVM_PATTERNS)
    rows = rows.select("doc_id", "_o", "_tag", "_repo", "_owner",
                       *[_candidates(k).alias(f"_s_{k}") for k in KINDS])
    every = F.concat(*[F.col(f"_s_{k}") for k in KINDS])
    rows = rows.select("doc_id", "_o", "_tag", "_repo", "_owner", _in_order(every).alias("_spans"),
                       *[F.size(f"_s_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS])
    return stage_table(rows, "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each candidate hash, corpus-wide.

    Counted in levels (hash, owner, repository), so a hash that sits in a third
    of all rows shrinks to one row per repository on the map side, before
    anything is dealt out by hash alone."""
    every = found.where(F.size("_spans") > 0).select("_repo", "_owner", F.explode("_spans.hash").alias("hash"))
    by_repo = every.groupBy("hash", "_owner", "_repo").agg(F.count(F.lit(1)).alias("n"))
    return by_repo.groupBy("hash").agg(F.sum("n").alias("n_seen"), F.count(F.lit(1)).alias("n_repositories"),
                                       F.count_distinct("_owner").alias("n_owners"))


def verdicts(found: DataFrame, example_owners: int = EXAMPLE_OWNERS,
             example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """Verdict of every candidate of a document: (_o, _tag, kind, start, end,
    verdict, repositories), where verdict is example, live or weak.  A value is
    widely copied by its owners, or by the repositories of more than one owner;
    what one owner has in many repositories is still that owner's."""
    each = (found.where(F.size("_spans") > 0)
            .select("_o", "_tag", F.explode("_spans").alias("s"))
            .select("_o", "_tag", "s.*"))
    counts = ownership(found).select("hash", "n_owners", "n_repositories")
    copied = (F.col("n_owners") >= example_owners) | (
        (F.col("n_owners") > 1) & (F.col("n_repositories") >= example_repositories))
    verdict = F.when(copied, "example").when(F.col("looks_live"), "live").otherwise("weak")
    return each.join(counts, "hash").select("_o", "_tag", "kind", "start", "end", verdict.alias("verdict"),
                                            F.col("n_repositories").alias("repositories"))


def by_document(found: DataFrame, example_owners: int = EXAMPLE_OWNERS,
                example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """Verdicts gathered by document, a row per document with candidates: sets,
    as a document given twice brings each of its candidates twice."""
    return verdicts(found, example_owners, example_repositories).groupBy("_o", "_tag").agg(
        F.array_sort(F.collect_set(F.struct("start", "end", "kind", "verdict", "repositories"))).alias("_verdicts"))


def scan_secrets(docs: DataFrame, repository: str = "source", example_owners: int = EXAMPLE_OWNERS,
                 example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """Secrets of every text of ``docs`` (doc_id, text, repository), a row per row.

    NULL text counts as empty, a NULL repository as the repository without a
    name.  Repeated rows each return the result of their document; they add no
    owner.  An empty table gives none; other columns are ignored.  Texts are
    scanned whole.

    ``spans`` lists all spans, base_sha256 covers the base kinds.  n_live counts
    owner-specific values that look random, n_example the widely copied ones
    (see ``verdicts``); live_spans are the former, live_repositories the number
    of repositories of the one that most of them hold (0 without any).  Private
    keys are spans from header to end line, judged by their bodies."""
    found = candidates(docs, repository)
    marks = by_document(found, example_owners, example_repositories).select(
        F.col("_o").alias("_vo"), F.col("_tag").alias("_vt"), "_verdicts")
    rows = found.join(marks, (F.col("_o") == F.col("_vo")) & (F.col("_tag") == F.col("_vt")), "left")
    base = F.filter("_spans", lambda s: s["kind"].isin(*BASE_KINDS))
    of = lambda v: F.filter(F.coalesce(
        F.col("_verdicts"), F.array().cast(
            "array<struct<start:int,end:int,kind:string,verdict:string,repositories:bigint>>")),
        lambda s: s["verdict"] == v)
    return rows.select(
        "doc_id", *[f"n_{k}" for k in BASE_KINDS], F.sha2(S.span_text(base), 256).alias("base_sha256"),
        S.span_text(F.col("_spans")).alias("spans"), F.size(of("live")).cast("long").alias("n_live"),
        F.size(of("example")).cast("long").alias("n_example"),
        S.span_text(_in_order(of("live"))).alias("live_spans"),
        F.coalesce(F.array_max(F.transform(of("live"), lambda s: s["repositories"])), F.lit(0)).cast("long")
        .alias("live_repositories"))


def redact_live(docs: DataFrame, repository: str = "source", example_owners: int = EXAMPLE_OWNERS,
                example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """``docs`` with every live secret replaced by a mark; all rows and columns
    stay, copied examples stay.  Overlapping spans are replaced together.

    NULL and empty texts stay as they are, repeated rows are redacted alike, an
    empty table stays empty.  Columns may have any names and keep their values
    and types.  The verdicts are those of ``scan_secrets``."""
    found = candidates(docs, repository)
    live = by_document(found, example_owners, example_repositories).select(
        F.col("_o").alias("_vo"), F.col("_tag").alias("_vt"),
        F.filter("_verdicts", lambda s: s["verdict"] == "live").alias("_live")).where(F.size("_live") > 0)
    rows = whole_rows(docs).join(live, (F.col("_o") == F.col("_vo")) & (F.col("_tag") == F.col("_vt")), "left")
    text = F.col("_row").getField("text")

    def cut(acc: Column, s: Column) -> Column:
        gap = text.substr(acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(REDACTED))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("_live", start, cut, lambda acc: F.concat(
        acc["out"], text.substr(acc["at"] + 1, F.length(text))))
    row = F.when(F.col("_live").isNotNull(), F.col("_row").withField("text", clean)).otherwise(F.col("_row"))
    return rows.select(row.alias("_row")).select("_row.*")


def op7_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scan_secrets`` over the whole documents table (NULL text: empty;
    repeated rows: a row each; an empty table gives none)."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def _sql() -> str:
    # matches too short to pass are left out by the pattern, as listing every
    # run of hex letters is quadratic in SQL
    q = {k: v.replace("'", "''") for k, v in PATTERNS.items()} | {"hex": JVM_PATTERNS["hex"][0]}
    assigned = f"regexp_extract(s.match, '{q['assign']}', 2)"
    body = "regexp_replace(regexp_extract(s.match, '(?s)PRIVATE KEY-----(.*)-----END ', 1), '[\\x20\\t\\n\\r\\f]|\\\\[nr]', '', 'g')"
    value = {"assign": assigned, "pem": body}
    least = " ".join(f"WHEN '{k}' THEN {n}" for k, n in LIVE_CHARS.items())
    keep = {"assign": f"length({assigned}) >= 8", "access": "length(s.match) >= 16", "hex": "length(s.match) >= 32",
            "code": "length(s.match) >= 40", "jwt": "true", "pem": "true"}
    lists = ",\n  ".join(
        f"list_transform(list_filter({S.sql_spans(k, f'm_{k}', f'g_{k}')}, lambda s: {keep[k]}), lambda s: {{'start': s.start, "
        f"'place': {i}, 'kind': s.kind, 'finish': s.start + length(s.match), "
        f"'val': {value.get(k, 's.match')}}}) AS s_{k}"
        for i, k in enumerate(KINDS))
    found = S.sql_found(q, "t")
    every = "s_assign"
    for k in KINDS[1:]:
        every = f"list_concat({every}, s_{k})"
    label = lambda spans: (f"coalesce(array_to_string(list_transform({spans}, lambda s: s.kind || ':' || s.start || ':' "  # noqa: E731
                           "|| s.finish), ','), '')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS repo, coalesce(text, '') AS t FROM documents),
m AS (SELECT rid, doc_id, repo, split_part(repo, '/', 1) AS owner,
  {lists}
FROM (SELECT *, {found} FROM d)),
a AS (SELECT rid, doc_id, repo, owner, len(s_assign) AS n_assign, len(s_access) AS n_access, len(s_hex) AS n_hex,
  list_sort({every}) AS spans FROM m),
x AS (SELECT rid, repo, owner, unnest(spans, recursive := true) FROM a),
o AS (SELECT val, count(DISTINCT owner) AS owners, count(DISTINCT repo) AS repos FROM x GROUP BY val),
v AS (SELECT rid, start, place, kind, finish, repos,
  CASE WHEN owners >= {EXAMPLE_OWNERS} OR owners > 1 AND repos >= {EXAMPLE_REPOSITORIES} THEN 'example'
    WHEN length(val) >= CASE kind {least} ELSE {OTHER_CHARS} END AND regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]')
      AND len(list_distinct(string_split(val, ''))) >= {LIVE_VARIETY}
      AND (kind = 'pem' OR NOT regexp_matches(lower(val), '{PLACEHOLDERS}')
        AND length(regexp_replace(lower(val), '{FILLING}', '', 'g')) * 2 >= length(val)) THEN 'live' ELSE 'weak' END AS verdict
  FROM x JOIN o USING (val)),
g AS (SELECT rid, count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example,
  string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, place) FILTER (verdict = 'live') AS live_spans,
  max(repos) FILTER (verdict = 'live') AS live_repositories FROM v GROUP BY rid)
SELECT doc_id, n_assign::BIGINT AS n_assign, n_access::BIGINT AS n_access, n_hex::BIGINT AS n_hex,
  sha256({label("list_filter(spans, lambda s: s.place < 3)")}) AS base_sha256, {label("spans")} AS spans,
  coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example, coalesce(live_spans, '') AS live_spans,
  coalesce(live_repositories, 0)::BIGINT AS live_repositories
FROM a LEFT JOIN g USING (rid)
"""


QUERIES = {"op7_scan_secrets": op7_scan_secrets}
ORACLES = {"op7_scan_secrets": _sql()}
