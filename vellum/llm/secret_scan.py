"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base kinds are found by their patterns in every text, left to right without overlap. Wider candidates (tokens with
mixed classes, provider prefixes, key blocks) are found likewise. Every candidate's value is hashed, and for each hash
the distinct owners and repositories that hold it are counted over the whole corpus: a value that more than
EXAMPLE_OWNERS owners share, or that more than EXAMPLE_REPOSITORIES repositories hold even of one owner, is a copied
example; one that stays with few of both looks live. Base spans always stay;
wider candidates are added as spans only where they look live and no base span overlaps them.

Counting is made of partial sums: values are first made distinct for each owner and repository, so that a value that
a third of all rows hold is no single task's. A null text is an empty one. A null owner counts as an owner of its
own. Repeated rows each get their result. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.shared import stored, text_or_empty


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


_KEY = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: Fixed patterns. A longer minimum in a pattern stands for a later check of the length only where both find the same.
KINDS = (
    Kind("assign", rf"({_KEY})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8, True),
    Kind("access", r"AKIA[A-Z0-9]{12,}", 0, 16, True),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32, True),
    Kind("prefixed", r"(?:gh[pousr]_|xox[abpr]-|sk_live_|glpat-)[A-Za-z0-9_-]{16,}"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Kind("block", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Kind("mixed", r"[A-Za-z0-9+/_-]{24,}"),
)
#: Most owners and repositories of a value that still looks live, and pieces of a text whose lengths are summed in one go.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES, PIECES = 2, 10, 256
SPAN = "struct<start:bigint,ends:bigint,k:int,value:string>"


def _bound(value: Column, use) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def found(text: Column, kind: Kind, k: int) -> Column:
    """Array of (start, ends, k, sha256 of the value), in code points: lengths of the pieces between matches and of
    the matches, summed up from the left, PIECES at a time; so the work is not quadratic in a text's matches."""
    whole, value = F.regexp_extract_all(text, F.lit(kind.pattern), 0), F.regexp_extract_all(text, F.lit(kind.pattern), kind.group)
    steps = F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"), whole.alias("hit"), value.alias("value"))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        start = a["at"] + F.length(s["gap"])
        ends = start + F.length(s["hit"])
        hit = F.struct(start.cast("long").alias("start"), ends.cast("long").alias("ends"), F.lit(k).alias("k"), F.sha2(s["value"], 256).alias("value"))
        wanted = s["hit"].isNotNull() & (F.length(s["value"]) >= kind.least)
        if kind.name == "mixed":
            wanted &= s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]")
        return F.struct(F.coalesce(ends, start).cast("long").alias("at"), F.when(wanted, F.array_append(a["out"], hit)).otherwise(a["out"]).alias("out"))

    def firsts(parts: Column) -> Column:
        """Where each part begins, and then the end."""
        longs = F.array(F.lit(0).cast("long"))
        return F.aggregate(parts, longs, lambda a, p: F.array_append(a, F.element_at(a, -1) + p["at"]))

    def moved(part: Column, by: Column) -> Column:
        return F.transform(part["out"], lambda s: F.struct((s["start"] + by).alias("start"), (s["ends"] + by).alias("ends"), s["k"].alias("k"), s["value"].alias("value")))

    def summed(all_steps: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_steps) - 1) / PIECES).cast("int")), lambda i: F.aggregate(F.slice(all_steps, i * PIECES + 1, PIECES), none, step))
        return _bound(parts, lambda p: F.flatten(F.zip_with(p, F.slice(firsts(p), F.lit(1), F.size(p)), moved)))

    return F.when(text.rlike(kind.pattern), _bound(steps, summed)).otherwise(F.array().cast(f"array<{SPAN}>"))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k.name) for k in KINDS))
    inner = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["ends"].cast("string")))
    return F.array_join(inner, ",")


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, most_owners, most_repositories) for
    each row of docs.

    Spans are sorted by start, then kind as listed in KINDS. n_live and n_example count all candidates' values; most_owners
    and most_repositories are the greatest counts of one of them (0 without any)."""
    text = text_or_empty()
    base = F.concat(*(found(text, k, i) for i, k in enumerate(KINDS) if k.base))
    wide = F.concat(*(found(text, k, i) for i, k in enumerate(KINDS) if not k.base))
    order = lambda a: F.transform(a, lambda s: F.struct(s["start"], s["k"], s["ends"], s["value"]))
    rows = docs.select("doc_id", F.col(owner).cast("string").alias("_owner"), F.col(repository).cast("string").alias("_repo"), order(base).alias("_base"), wide.alias("_w"))
    apart = F.filter("_w", lambda w: ~F.exists("_base", lambda b: (b["start"] < w["ends"]) & (w["start"] < b["ends"])))
    rows = rows.select("doc_id", "_owner", "_repo", "_base", order(apart).alias("_wide"), F.monotonically_increasing_id().alias("_row"))
    rows = stored(rows, "candidates")
    each = rows.where((F.size("_base") > 0) | (F.size("_wide") > 0)).select("_row", "_owner", "_repo", F.explode(F.concat(F.transform("_base", lambda s: F.struct(s.alias("s"), F.lit(True).alias("base"))), F.transform("_wide", lambda s: F.struct(s.alias("s"), F.lit(False).alias("base"))))).alias("x"))
    each = each.select("_row", "_owner", "_repo", F.col("x.s").alias("s"), F.col("x.base").alias("base"), F.col("x.s.value").alias("value"))
    held = each.groupBy("value", "_owner", "_repo").agg(F.count("*").alias("n")).groupBy("value", "_owner").agg(F.count("*").alias("repos"))
    owned = stored(held.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos")), "owned")
    each = each.join(owned, "value").withColumn("live", (F.col("owners") <= example_owners) & (F.col("repos") <= example_repositories))
    added = each.groupBy("_row").agg(
        F.collect_list(F.when(~F.col("base") & F.col("live"), F.col("s"))).alias("_more"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example"),
        F.max("owners").alias("most_owners"), F.max("repos").alias("most_repositories"),
    )
    out = rows.join(added, "_row", "left")
    count = lambda i: F.size(F.filter("_base", lambda s: s["k"] == i)).cast("long")
    return out.select(
        "doc_id", *(count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS) if k.base), F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.concat("_base", F.coalesce("_more", F.filter("_base", lambda s: F.lit(False))))).alias("spans"),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_live", "n_example", "most_owners", "most_repositories")),
    )


def _oracle() -> str:
    """The same in SQL."""
    one = []
    for i, k in enumerate(KINDS):
        mixed = " AND regexp_matches(s.value, '[0-9]') AND regexp_matches(s.value, '[a-z]') AND regexp_matches(s.value, '[A-Z]')" if k.name == "mixed" else ""
        p = k.pattern.replace("'", "''")
        one.append(f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{p}', 0)) + 1), lambda i: {{
  'start': coalesce(list_sum(list_transform(regexp_split_to_array(t, '{p}')[1:i], lambda x: length(x))), 0)::BIGINT
    + coalesce(list_sum(list_transform(regexp_extract_all(t, '{p}', 0)[1:i - 1], lambda x: length(x))), 0)::BIGINT, 'k': {i},
  'n': length(regexp_extract_all(t, '{p}', 0)[i]), 'value': regexp_extract_all(t, '{p}', {k.group})[i]}}), lambda s: length(s.value) >= {k.least}{mixed})""")
    base = " || ".join(x for x, k in zip(one, KINDS) if k.base)
    wide = " || ".join(x for x, k in zip(one, KINDS) if not k.base)
    names = [k.name for k in KINDS]
    live = f"(owners <= {EXAMPLE_OWNERS} AND repos <= {EXAMPLE_REPOSITORIES})"
    joined = f"list_aggregate(list_transform(list_sort({{}}), lambda s: ({names})[s.k + 1] || ':' || s.start || ':' || (s.start + s.n)), 'string_agg', ',')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
f AS (SELECT r, doc_id, source, {base} AS b, {wide} AS w FROM d),
a AS (SELECT r, doc_id, source, b, list_filter(w, lambda x: len(list_filter(b, lambda y: y.start < x.start + x.n AND x.start < y.start + y.n)) = 0) AS w FROM f),
e AS (SELECT r, doc_id, source, unnest(list_transform(b, lambda s: {{'s': s, 'base': true}}) || list_transform(w, lambda s: {{'s': s, 'base': false}})) AS x FROM a),
h AS (SELECT DISTINCT x.s.value AS value, source, doc_id FROM e),
o AS (SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners, count(*) AS repos FROM h GROUP BY 1),
m AS (SELECT r, list(x.s) FILTER (NOT x.base AND {live}) AS more, count(*) FILTER ({live}) AS n_live,
  count(*) FILTER (NOT {live}) AS n_example, max(owners) AS most_owners, max(repos) AS most_repositories FROM e JOIN o ON e.x.s.value = o.value GROUP BY r)
SELECT doc_id, {", ".join(f"len(list_filter(b, lambda s: s.k = {i}))::BIGINT AS n_{k.name}" for i, k in enumerate(KINDS) if k.base)},
  sha256(coalesce({joined.format("b")}, '')) AS base_sha256, coalesce({joined.format("b || coalesce(more, [])")}, '') AS spans,
  {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in ("n_live", "n_example", "most_owners", "most_repositories"))}
FROM a LEFT JOIN m USING (r)
"""


ORACLE_SQL = _oracle()
