"""Secret scan by corpus-wide ownership frequency, with DataFrame functions only.

Patterns find the base spans: assigned values, access keys and hexadecimal keys.  Every value
is a candidate, and so is every bare run of credential characters with letters and digits.
Candidates are hashed, and for each hash the distinct repositories and owners that hold it
are counted over the whole corpus.  A value that several owners hold was copied from some
documentation (``example``); one that stays with its owner and looks random is ``live``;
the rest is ``weak`` (words, placeholders).

The method adds spans of kind ``token``: bare runs outside all base spans that are live and
either marked by a base pattern elsewhere in the corpus (the same secret without its context)
or mixed enough to speak for themselves.  Base spans always stay.

Texts are read once and never shuffled; what moves are the spans of the documents that have
any.  Counting is map-side first, and verdicts come back through a measured broadcast or a
salted join, so a key copied into a third of all rows is no hot spot.

Defined cases: a null text is empty; rows are told apart by position, so repeated rows and
repeated or null ids give a row each; a null owner or repository counts as one of its own;
texts of any length are read whole; an empty table gives an empty result; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnish.operators.skew import attach
from burnish.session import materialise

KINDS = ("assign", "access", "hex", "token")
# Patterns of the contract (fixed values).  A run of 24 hexadecimal digits is a maximal run of that length.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

RUN = r"[A-Za-z0-9+/_.-]{12,}"
EDGES = "+/_.=-"  # cut off a value before it is hashed
LIVE_LENGTH = (12, 256)
LIVE_CHARS = 8
PLACEHOLDER = "example|sample|dummy|changeme|placeholder|xxxx"
MIXED = r"^[A-Za-z0-9_-]{20,}$"
MIXED_CHARS = 12
WIDE_OWNERS = 3
WIDE_REPOSITORIES = 10


def core(value: Column) -> Column:
    """A value without the punctuation around it."""
    return F.btrim(value, F.lit(EDGES))


def _distinct_chars(value: Column) -> Column:
    return F.size(F.array_distinct(F.split(value, "")))


def looks_live(value: Column) -> Column:
    """Letters and digits, of a key's length, not repetitive and no placeholder."""
    return (
        F.length(value).between(*LIVE_LENGTH)
        & value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & ~F.lower(value).rlike(PLACEHOLDER)
        & (_distinct_chars(value) >= LIVE_CHARS)
    )


def looks_mixed(value: Column) -> Column:
    """Enough of a mixture of cases and digits to be a key without any context."""
    return value.rlike(MIXED) & value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]") & (_distinct_chars(value) >= MIXED_CHARS)


def _hits(number: int, pattern: str, group: int, wanted: Column | None = None) -> Column:
    """Gaps before matches, matches and values of one kind; null for texts without any."""
    text = F.col("_text")
    found = F.struct(
        F.lit(number).alias("kind"),
        F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("vals"),
    )
    return F.when(text.rlike(pattern) if wanted is None else wanted, found)


def _base_spans(found: DataFrame) -> DataFrame:
    """Spans of all kinds with their positions, failing matches dropped."""
    one = found.select("_row", "_owner", "_repo", F.explode(F.array_compact("found")).alias("f"))
    pieces = one.select("_row", "_owner", "_repo", F.col("f.kind").alias("kind"), F.posexplode(F.arrays_zip("f.gaps", "f.hits", "f.vals")).alias("i", "m"))
    long = F.coalesce(F.length("m.hits"), F.lit(0))
    so_far = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.withColumn("end", F.sum(F.col("m.gaps") + long).over(so_far)).withColumn("value", core(F.col("m.vals")))
    token = F.col("kind") == 3
    lead = F.when(token, F.length("m.hits") - F.length(F.ltrim(F.col("m.hits"), F.lit(EDGES)))).otherwise(F.lit(0))
    start = F.col("end") - F.length("m.hits") + lead
    fits = (
        F.when(F.col("kind") == 0, F.length("m.vals") >= LEAST_ASSIGN)
        .when(F.col("kind") == 1, F.length("m.vals") >= LEAST_ACCESS)
        .when(token, looks_live(F.col("value")))
        .otherwise(F.col("m.hits").isNotNull())
    )
    return placed.filter(F.col("m.hits").isNotNull() & fits).select(
        "_row", "_owner", "_repo", "kind", start.alias("start"), F.when(token, start + F.length("value")).otherwise(F.col("end")).alias("end"), "value"
    )


def _outside(spans: DataFrame) -> DataFrame:
    """Leaves out bare runs that overlap a base span."""
    token = F.col("kind") == 3
    by_start = Window.partitionBy("_row").orderBy("start")
    reached = F.max(F.when(~token, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(~token, F.col("start"))).over(by_start.rangeBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(reached, F.lit(0)) <= F.col("start")) & (F.coalesce(ahead, F.col("end")) >= F.col("end"))
    return spans.withColumn("_free", free).filter(~token | F.col("_free")).drop("_free")


def ownership(spans: DataFrame) -> DataFrame:
    """Per value hash: owners, repositories and base marks, counted map-side first."""
    held = spans.groupBy("value_sha256", "_owner", "_repo").agg(F.count_if(F.col("kind") < 3).alias("n"))
    owners = held.groupBy("value_sha256", "_owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    return owners.groupBy("value_sha256").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("repos").cast("long").alias("n_repositories"), F.sum("n").cast("long").alias("n_marked")
    )


def survey(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    wide_owners: int = WIDE_OWNERS,
    wide_repositories: int = WIDE_REPOSITORIES,
) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every document with its row number, and every span with its owners and verdict.

    A value is an example if ``wide_owners`` owners hold it, or if two do in at least
    ``wide_repositories`` repositories together.
    """
    whole = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id"),
        F.col(owner).cast("string").alias("_owner"),
        F.col(repository).cast("string").alias("_repo"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
    )
    bare = F.exists(F.regexp_extract_all("_text", F.lit(RUN), F.lit(0)), lambda r: looks_live(core(r)))
    found = F.array(_hits(0, ASSIGN, 2), _hits(1, ACCESS, 0), _hits(2, HEX, 0), _hits(3, RUN, 0, bare))
    stored = materialise(whole.select("_row", "doc_id", "_owner", "_repo", found.alias("found")), "secrets")
    spans = _outside(_base_spans(stored)).withColumn("value_sha256", F.sha2("value", 256))
    spans = materialise(spans, "secret-spans")
    spans = attach(spans, ownership(spans), ["value_sha256"])
    wide = (F.col("n_owners") >= wide_owners) | ((F.col("n_owners") > 1) & (F.col("n_repositories") >= wide_repositories))
    live = looks_live(F.col("value"))
    verdict = F.when(wide, "example").when(live, "live").otherwise("weak")
    spans = spans.withColumn("verdict", verdict)
    own = (F.col("n_marked") > 0) | looks_mixed(F.col("value"))
    spans = spans.filter((F.col("kind") < 3) | ((F.col("verdict") == "live") & own))
    return stored.select("_row", "doc_id"), spans


def find(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per span: document, kind, place, hash of the value, who holds it and the verdict."""
    rows, spans = survey(docs, owner, repository)
    names = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    return spans.join(rows, "_row").select(
        "doc_id", names.alias("kind"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        "value_sha256", "n_owners", "n_repositories", "verdict",
    )


def report(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per document: counts, spans in order, and the verdict of each."""
    rows, spans = survey(docs, owner, repository)
    each = spans.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "verdict"))).alias("s"))
    done = rows.join(each, "_row", "left").withColumn("s", F.coalesce("s", F.expr("array()").cast(each.schema["s"].dataType)))
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    written = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", name(x), x["start"], x["end"])), ",")
    base = F.filter("s", lambda x: x["kind"] < 3)
    count = lambda field, value: F.size(F.filter("s", lambda x: x[field] == value)).cast("long")
    return done.select(
        "doc_id",
        *[count("kind", i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("s")).alias("spans"),
        F.array_join(F.transform("s", lambda x: x["verdict"]), ",").alias("verdicts"),
        count("verdict", "live").alias("n_live"),
        count("verdict", "example").alias("n_example"),
    )


OP11_SQL = rf"""
WITH whole AS (SELECT row_number() OVER () AS r, doc_id, source AS own, CAST(doc_id AS VARCHAR) AS repo, coalesce(text, '') AS text FROM documents),
hits AS (
  SELECT r, 0 AS kind, regexp_extract_all(text, '{ASSIGN.replace("'", "''")}') AS h,
         regexp_extract_all(text, '{ASSIGN.replace("'", "''")}', 2) AS v, string_split_regex(text, '{ASSIGN.replace("'", "''")}') AS g FROM whole
  UNION ALL SELECT r, 1, regexp_extract_all(text, '{ACCESS}'), regexp_extract_all(text, '{ACCESS}'), string_split_regex(text, '{ACCESS}') FROM whole
  UNION ALL SELECT r, 2, regexp_extract_all(text, '{HEX}'), regexp_extract_all(text, '{HEX}'), string_split_regex(text, '{HEX}') FROM whole
  UNION ALL SELECT r, 3, regexp_extract_all(text, '{RUN}'), regexp_extract_all(text, '{RUN}'), string_split_regex(text, '{RUN}') FROM whole),
listed AS (SELECT r, kind, generate_subscripts(h, 1) AS i, unnest(h) AS h, unnest(v) AS v, unnest(g[1:len(h)]) AS g FROM hits),
placed AS (SELECT *, sum(length(g) + length(h)) OVER (PARTITION BY r, kind ORDER BY i) AS stop, trim(v, '{EDGES}') AS value FROM listed),
spans AS (
  SELECT r, kind, stop - length(h) + CASE WHEN kind = 3 THEN length(h) - length(ltrim(h, '{EDGES}')) ELSE 0 END AS start,
         CASE WHEN kind = 3 THEN stop - length(h) + length(h) - length(ltrim(h, '{EDGES}')) + length(value) ELSE stop END AS stop, value,
         length(value) BETWEEN {LIVE_LENGTH[0]} AND {LIVE_LENGTH[1]} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
           AND NOT regexp_matches(lower(value), '{PLACEHOLDER}') AND len(list_distinct(string_split(value, ''))) >= {LIVE_CHARS} AS live
  FROM placed WHERE CASE kind WHEN 0 THEN length(v) >= {LEAST_ASSIGN} WHEN 1 THEN length(v) >= {LEAST_ACCESS} ELSE true END),
free AS (
  SELECT * FROM spans s WHERE kind < 3 OR (live AND NOT EXISTS (
    SELECT 1 FROM spans b WHERE b.kind < 3 AND b.r = s.r AND b.start < s.stop AND b.stop > s.start))),
owned AS (
  SELECT value, count(DISTINCT coalesce('=' || own, '')) AS owners,
         count(DISTINCT coalesce('=' || own, '') || chr(10) || coalesce('=' || repo, '')) AS repos, count(*) FILTER (kind < 3) AS marked
  FROM free JOIN whole USING (r) GROUP BY value),
judged AS (
  SELECT f.*, CASE WHEN owners >= {WIDE_OWNERS} OR (owners > 1 AND repos >= {WIDE_REPOSITORIES}) THEN 'example' WHEN live THEN 'live' ELSE 'weak' END AS verdict,
         marked > 0 OR (regexp_matches(value, '{MIXED}') AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]')
           AND regexp_matches(value, '[A-Z]') AND len(list_distinct(string_split(value, ''))) >= {MIXED_CHARS}) AS evident
  FROM free f JOIN owned USING (value)),
kept AS (
  SELECT *, CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'token' END || ':' || start || ':' || stop AS s
  FROM judged WHERE kind < 3 OR (verdict = 'live' AND evident)),
per AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         coalesce(string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3), '') AS base, string_agg(s, ',' ORDER BY start, kind) AS spans,
         string_agg(verdict, ',' ORDER BY start, kind) AS verdicts,
         count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example
  FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(verdicts, '') AS verdicts,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM whole LEFT JOIN per USING (r)
"""
