"""URL filter by a path-template tree.

Every host has a tree of path segments. Runs of digits in a segment become ``#``. Then, level by
level, a place with more than FAN different segments is variable: those of its branches whose share
of blocked URLs does not differ from their parent's by more than chance are merged into the wildcard
``*``, the others stay. The paths through the merged tree are the host's templates.

The labels are the rules' own: URLs that a rule blocks or allows. A branch's purity is the blocked
share of its labelled URLs, smoothed towards its parent's, and the host's towards that of all
labelled URLs; an only child has its parent's. A template's purity is the blocked share of its
labelled URLs, smoothed towards the mean of two: its branch's purity, and that of all templates of
the same shape on whatever host. So a template without labels is rejected where both its place on
the host and its shape elsewhere speak against it.

The tree is never gathered per host: a level is grouped sums over distinct normalised paths, so a
host with most of the pages is pre-aggregated like any other. A path that is alone in its branch is
finished, so there are as many levels as paths of one host have in common, not as a path is long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import LOWER, UPPER, join_groups
from tidelog.sources.shared import written

#: (rule, verdict) of the registered query.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow")]
#: Different segments from which a place is variable.
FAN = 16
#: Standard deviations by which a branch must differ to stay apart.
Z = 3.0
#: Weight of what purity is smoothed towards, and the purity from which a template is rejected.
WEIGHT, PURITY = 10.0, 0.85


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a url without ://."""
    pattern = "://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER)
    return (F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit("")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits."""
    rule = verdict = None
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        site, _, rest = text.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith("/" + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def segments(path: Column) -> Column:
    """The path's segments, digits generalised; an empty path has none."""
    return F.slice(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), 2, F.octet_length(path) + 1)


def _smoothed(blocked: Column, labelled: Column, towards: Column) -> Column:
    return (blocked + F.lit(WEIGHT) * towards) / (labelled + F.lit(WEIGHT))


def templates(urls: DataFrame) -> DataFrame:
    """host, segs, n, template, purity for ``urls`` (host, segs, said): a row per distinct
    normalised path. ``said`` is the verdict of a rule, null where none fits."""
    labelled = F.count("said").alias("l")
    blocked = F.coalesce(F.sum((F.col("said") == "block").cast("long")), F.lit(0)).alias("b")
    paths = written(urls.groupBy("host", "segs").agg(F.count("*").alias("n"), labelled, blocked),
                    "url_paths")
    size, all_l, all_b = paths.agg(F.count("*"), F.sum("l"), F.sum("b")).first()
    overall = F.lit(((all_b or 0) + 1.0) / ((all_l or 0) + 2.0))
    hosts = written(paths.groupBy("host").agg(
        F.sum("l").alias("hl"), F.sum("b").alias("hb"), F.count("*").alias("rows")), "url_hosts")
    active = join_groups(paths, hosts, ["host"], "rows", size).select(
        "host", "segs", "n", "l", "b", F.lit("").alias("t"),
        _smoothed(F.col("hb"), F.col("hl"), overall).alias("p"))
    done, level = [], 0
    while True:
        active = written(active, "url_active")
        ended = active.filter(F.size("segs") <= level)
        done.append(ended)
        level += 1
        active = active.filter(F.size("segs") >= level).withColumn("seg", F.get("segs", F.lit(level - 1)))
        if not active.take(1):
            break
        branch = written(active.groupBy("host", "t", "p", "seg").agg(
            F.sum("l").alias("bl"), F.sum("b").alias("bb"), F.count("*").alias("rows")), "url_branches")
        parent = branch.groupBy("host", "t").agg(
            F.sum("bl").alias("pl"), F.sum("bb").alias("pb"), F.count("*").alias("children"))
        rate = (F.col("pb") + 1.0) / (F.col("pl") + 2.0)
        apart = (F.col("bl") > 0) & (F.abs(F.col("bb") / F.greatest("bl", F.lit(1)) - rate) > Z * F.sqrt(
            rate * (1.0 - rate) / F.greatest("bl", F.lit(1))))
        merged = (F.col("children") > FAN) & ~apart & (F.col("seg") != "")
        named = written(join_groups(branch, written(parent, "url_parents"), ["host", "t"], "children",
                                    size).select(
            "host", "t", "p", "seg", "bl", "bb", "rows", "children",
            F.concat("t", F.lit("/"), F.when(merged, "*").otherwise(F.col("seg"))).alias("t2")),
            "url_named")
        # Branches under one name: one purity.
        pooled = named.groupBy("host", "t", "t2").agg(
            F.sum("bl").alias("gl"), F.sum("bb").alias("gb"), F.sum("rows").alias("paths"),
            F.count("*").alias("branches"))
        chosen = written(join_groups(named, written(pooled, "url_pooled"), ["host", "t", "t2"],
                                     "branches", size).select(
            "host", "t", "seg", "rows", "t2", "paths", F.when(F.col("children") == 1, F.col("p")).otherwise(
                _smoothed(F.col("gb"), F.col("gl"), F.col("p"))).alias("p2")), "url_chosen")
        active = join_groups(active, chosen, ["host", "t", "seg"], "rows", size).select(
            "host", "segs", "n", "l", "b", F.col("t2").alias("t"), F.col("p2").alias("p"), "paths")
        active = written(active, "url_level")
        # Alone in its branch: only children follow, which change neither name nor purity.
        rest = F.slice("segs", level + 1, F.size("segs"))
        done.append(active.filter("paths = 1").withColumn("t", F.concat(
            F.col("t"), F.array_join(F.transform(rest, lambda x: F.concat(F.lit("/"), x)), ""))).drop("paths"))
        active = active.filter("paths > 1").drop("paths")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    found = written(found, "url_found")
    own = written(found.groupBy("host", "t").agg(
        F.sum("l").alias("tl"), F.sum("b").alias("tb"), F.count("*").alias("rows")), "url_templates")
    shape = own.groupBy("t").agg(F.sum("tl").alias("sl"), F.sum("tb").alias("sb"),
                                 F.count("*").alias("hosts"))
    own = join_groups(own, written(shape, "url_shapes"), ["t"], "hosts", size).select(
        "host", "t", "rows", "tl", "tb", _smoothed(F.col("sb"), F.col("sl"), overall).alias("ps"))
    own = written(own, "url_templates")
    both = (F.col("p") + F.col("ps")) / 2.0
    return join_groups(found, own, ["host", "t"], "rows", size).select(
        "host", "segs", "n", F.col("t").alias("template"),
        _smoothed(F.col("tb"), F.col("tl"), both).alias("purity"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """Contract of op2, one row per page: page_id, host, path, rule, verdict (and template, purity).

    A url that a rule fits takes the longest rule's verdict; another one is blocked if its template
    is. Null urls and those without :// have empty host and path and form one template; repeated
    rows are judged each; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules or RULES)
    rows = written(split.select("*", rule.alias("rule"), verdict.alias("said"),
                                segments(F.col("path")).alias("segs")), "url_rows")
    total = rows.count()
    judged = written(templates(rows.select("host", "segs", "said")), "url_judged")
    return join_groups(rows, judged, ["host", "segs"], "n", total).select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(F.col("purity") >= PURITY, "block").otherwise("allow"))
        .alias("verdict"), "template", "purity")


def _sql() -> str:
    rule = verdict = "end"
    for text, says in sorted(RULES, key=lambda r: (len(r[0]), r[0])):
        site, _, rest = text.partition("/")
        when = (f"when (host = '{site}' or ends_with(host, '.{site}')) "
                f"and starts_with(path, '/{rest}') then ")
        rule, verdict = f"{when}'{text}' {rule}", f"{when}'{says}' {verdict}"
    w = f"{WEIGHT}::double"
    return f"""
with recursive m as (select page_id, regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1) as h,
  regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) as path from pages),
hp as (select page_id, translate(h, '{UPPER}', '{LOWER}') as host, path from m),
r as (select *, case {rule} as rule, case {verdict} as said,
  string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/')[2:] as segs from hp),
d as (select host, segs, count(said) as l, count(*) filter (said = 'block') as b from r group by all),
o as (select (coalesce(sum(b), 0) + 1.0::double) / (coalesce(sum(l), 0) + 2.0::double) as g from d),
walk as (select host, segs, l, b, 0 as k, '' as t,
  (sum(b) over (partition by host) + {w} * g) / (sum(l) over (partition by host) + {w}) as p from d, o
  union all
  select host, segs, l, b, k + 1, t2, case when children = 1 then p
  else (sum(b) over v + {w} * p) / (sum(l) over v + {w}) end from (
  select *, t || '/' || case when children > {FAN} and seg <> '' and not (bl > 0 and
  abs(bb::double / greatest(bl, 1) - q) > {Z}::double * sqrt(q * (1.0::double - q) / greatest(bl, 1)))
  then '*' else seg end as t2 from (
  select *, count(distinct seg) over (partition by host, t) as children,
  (sum(b) over (partition by host, t) + 1.0::double) / (sum(l) over (partition by host, t) + 2.0::double)
  as q, sum(l) over (partition by host, t, seg) as bl, sum(b) over (partition by host, t, seg) as bb
  from (select *, segs[k + 1] as seg from walk where k < len(segs))))
  window v as (partition by host, t, t2)),
f as (select * from walk where k = len(segs)),
own as (select host, t, sum(l) as tl, sum(b) as tb from f group by all),
shape as (select t, sum(l) as sl, sum(b) as sb from f group by t),
j as (select host, segs, t as template, (tb + {w} * ((p + (sb + {w} * g) / (sl + {w})) / 2.0::double))
  / (tl + {w}) as purity from f join own using (host, t) join shape using (t), o)
select page_id, host, path, rule,
  coalesce(said, case when purity >= {PURITY} then 'block' else 'allow' end) as verdict,
  template, purity from r join j using (host, segs)
"""


ORACLE = _sql()
