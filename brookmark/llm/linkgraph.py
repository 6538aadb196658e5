"""URL verdicts from rules, and from the link graph where no rule fits, on DataFrame functions alone.

Hosts are the nodes, links between pages of different hosts the edges (one per ordered pair of
hosts). Trust starts at hosts in proportion to their pages that a rule allows and flows along links
(personalised PageRank); distrust starts in proportion to the pages that a rule blocks and flows
against them, from the linked host back to those that link to it. Mass shrinks with every step and
with the number of links that share it, so hosts are not judged by how much they hold but by what it
is made of: a page without a rule is blocked where distrust is more than ``share`` per cent of its
host's trust and distrust together (at 50: where blocked pages speak for more of the host than
allowed ones). ``least`` only keeps out masses so small that rounding down decides them. ``rounds``
is the length of the longest walk, in links, that counts: hosts farther from every seed keep no mass.
A host without any mass is allowed.

Masses are whole numbers (UNIT is one full seed), so sums do not depend on the order in which
tasks finish and a repeated task gives the same verdict.

A null url or one without ``://`` has an empty host and path; it belongs to no host and is allowed.
Null html has no links. Repeated pages count for their host's seeds each; repeated links are one
edge. The output has a row for each row of ``pages`` and no other column of theirs, so extra columns of any
name are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmark.llm.text import ascii_lower, staged

UNIT = 1_000_000_000
#: (verdict, host, path): fixed values of the contract.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)href\s*=\s*[\"']?\s*([^\"'\s>]+)"
_OUT = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    held = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(held, _URL, 1)), F.regexp_extract(held, _URL, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as a string, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest ends outermost
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        name = F.when(fits, at + start).otherwise(name)
        verdict = F.when(fits, said).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst): ordered pairs of different hosts that link; relative links stay on their host."""
    links = pages.select(
        F.col("__host").alias("src"), F.explode(F.array_distinct(F.regexp_extract_all(F.col("html"), F.lit(_LINK), 1))).alias("link")
    )
    out = links.select("src", ascii_lower(F.regexp_extract("link", _OUT, 1)).alias("dst"))
    return out.where("src <> '' and dst <> '' and src <> dst").distinct()


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = 10, damping: int = 85) -> DataFrame:
    """(kind, host, mass) after ``rounds`` steps; kind 0 is trust, 1 distrust.

    ``seeds`` has the same columns. Each step keeps ``100 - damping`` per cent of the seeds and
    passes ``damping`` per cent of each host's mass on in equal shares, rounded down. Shares are
    summed on the sending side first; a frame is stored every few steps, so that plans stay short.
    """
    degree = edges.groupBy("src").count().withColumnsRenamed({"src": "host", "count": "degree"})
    indegree = edges.groupBy("dst").count().withColumnsRenamed({"dst": "host", "count": "degree"})
    forward = edges.join(degree, F.col("src") == F.col("host")).select(F.lit(0).alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to"), "degree")
    back = edges.join(indegree, F.col("dst") == F.col("host")).select(F.lit(1).alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to"), "degree")
    ways = staged(forward.unionByName(back).withColumnRenamed("kind", "way"))
    kept = staged(seeds.select("kind", "host", F.expr(f"mass * {100 - damping} div 100").alias("mass")))
    mass = kept
    if ways.isEmpty():
        return mass
    for step in range(1, rounds + 1):
        sent = (
            mass.join(ways, (F.col("kind") == F.col("way")) & (F.col("host") == F.col("from")))
            .groupBy("kind", "to")
            .agg(F.sum(F.expr(f"mass * {damping} div (100 * degree)")).alias("mass"))
            .withColumnRenamed("to", "host")
        )
        mass = kept.unionByName(sent).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if step % 5 == 0 or step == rounds:
            mass = staged(mass)
    return mass


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, rounds: int = 10, share: int = 50, least: int = UNIT // 1_000_000
) -> DataFrame:
    """Every page with ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust``."""
    host, path = split_url(F.col("url"))
    named = pages.select("page_id", "url", "html").withColumns({"__host": host, "path": path})
    rule, said = rule_of(F.col("__host"), F.col("path"), rules)
    ruled = named.withColumns({"rule": rule, "said": said})
    per_host = ruled.where("__host <> ''").groupBy(F.col("__host").alias("host")).agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("said") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("said") == "block", 1)).alias("blocked"),
    )
    seeds = per_host.select(
        "host", F.explode(F.array(
            F.struct(F.lit(0).alias("kind"), F.col("allowed").alias("part"), "n"),
            F.struct(F.lit(1).alias("kind"), F.col("blocked").alias("part"), "n"),
        )).alias("s"),
    ).where("s.part > 0").select("s.kind", "host", F.expr(f"s.part * {UNIT} div s.n").alias("mass"))
    mass = propagate(seeds, host_edges(named), rounds)
    scores = mass.groupBy(F.col("host").alias("of")).agg(
        F.sum(F.when(F.col("kind") == 0, F.col("mass"))).alias("trust"),
        F.sum(F.when(F.col("kind") == 1, F.col("mass"))).alias("distrust"),
    )
    # hosts are unique in `scores`; a host with very many pages is split on the pages' side
    joined = ruled.join(scores, F.col("__host") == F.col("of"), "left")
    trust, distrust = (F.coalesce(F.col(c), F.lit(0)) for c in ("trust", "distrust"))
    spread = F.when((distrust >= least) & (100 * distrust > share * (trust + distrust)), "block").otherwise("allow")
    return joined.select(
        "page_id", F.col("__host").alias("host"), "path", "rule", F.coalesce("said", spread).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )


def oracle_sql(rules: Sequence[tuple[str, str, str]] = RULES, rounds: int = 10, damping: int = 85, share: int = 50, least: int = UNIT // 1_000_000) -> str:
    """The same verdicts in SQL, a step to a common table expression."""
    fits = [
        (f"((host = '{at}' or host like '%.{at}') and starts_with(path, '{start}'))", at + start, said)
        for said, at, start in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link, out, url = (p.replace("'", "''") for p in (_LINK.replace('\\"', '"'), _OUT, _URL))
    steps = []
    for i in range(1, rounds + 1):
        steps.append(f"""mass{i} as (
  select kind, host, cast(sum(mass) as bigint) as mass from (
    select kind, host, mass from mass0 union all
    select m.kind, w.t, (m.mass * {damping}) // (100 * w.degree) from mass{i - 1} m join ways w on m.kind = w.kind and m.host = w.f
  ) group by kind, host)""")
    return f"""
with named as (
  select page_id, html, {lower.format(f"regexp_extract(coalesce(url, ''), '{url}', 1)")} as host,
         regexp_extract(coalesce(url, ''), '{url}', 2) as path from pages
), ruled as (
  select *, case {' '.join(f"when {c} then '{r}'" for c, r, _ in fits)} end as rule,
         case {' '.join(f"when {c} then '{v}'" for c, _, v in fits)} end as said from named
), links as (
  select host as src, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) as link from ruled
), edges as (
  select distinct src, {lower.format(f"regexp_extract(link, '{out}', 1)")} as dst from links
  where src <> '' and regexp_extract(link, '{out}', 1) <> '' and src <> {lower.format(f"regexp_extract(link, '{out}', 1)")}
), ways as (
  select 0 as kind, src as f, dst as t, count(*) over (partition by src) as degree from edges union all
  select 1, dst, src, count(*) over (partition by dst) from edges
), hosts as (
  select host, count(*) as n, count(*) filter (where said = 'allow') as a, count(*) filter (where said = 'block') as b
  from ruled where host <> '' group by host
), mass0 as (
  select 0 as kind, host, ((a * {UNIT}) // n) * {100 - damping} // 100 as mass from hosts where a > 0 union all
  select 1, host, ((b * {UNIT}) // n) * {100 - damping} // 100 from hosts where b > 0
), {', '.join(steps)},
scores as (
  select host, coalesce(sum(mass) filter (where kind = 0), 0) as trust, coalesce(sum(mass) filter (where kind = 1), 0) as distrust
  from mass{rounds} group by host
)
select page_id, r.host, path, rule,
       coalesce(said, case when distrust >= {least} and 100 * distrust > {share} * (trust + distrust) then 'block' else 'allow' end) as verdict
from ruled r left join scores s on r.host = s.host
"""
