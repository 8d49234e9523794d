"""URL filters: host rules, then a path-template tree built from the urls.

Paths are cut into segments and digit runs are generalised at once
(``25930.html`` -> ``{n}.html``). The tree is then grown level by level, per
host: a segment value with few urls under its parent becomes the wildcard
``*``, and a value whose labelled purity does not differ statistically from
its siblings' (a two-proportion z-test against the parent) is merged into the
wildcard too. The others are put in order of their purity and merged with the
one before as long as a two-proportion z-test tells no difference: a merged
branch is named ``{a+2}``, by its smallest value and how many others it has. The tree grows until no branch is left that could have a segment value
of its own: with a further segment, several paths, enough urls, and labels of both kinds;
what lies deeper are wildcards. Empty segments count as none. A template is rejected when its smoothed labelled purity,
``(good + prior * K) / (labelled + K)``, falls below ``MIN_PURITY``.

All steps are joins and groupings of built-in functions. The urls are first
aggregated to distinct generalised paths per host, and only those small rows
go through the tree; every grouping aggregates before its shuffle, so a hot
host costs no more than its number of distinct paths. The order of siblings is
one of their distinct (labelled, good) counts, not of the siblings.

Defined results: a null url, or one without ``://``, has an empty host and
path and its own template; an unlabelled template has the prior's purity and
is allowed; duplicated rows are judged one by one and count twice; a document
with conflicting labels counts by its smallest label; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, narrow, table

MIN_URLS = 20             # urls under which a segment value is generalised
Z_DIFFERENT = 3.0         # standard errors from which a branch stands alone
SMOOTHING = 10.0          # pseudo-labels at the prior's purity
MIN_PURITY = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    HostRule("allow", "org"),
    HostRule("block", "example.org", "/es/"),
    HostRule("block", "example.org", "/en/1"),
    HostRule("allow", "com", "/fr/"),
    HostRule("block", "com", "/de/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def best_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    return (name, verdict) if name is not None else (F.lit(None).cast("string"),) * 2


def _shape(path: Column) -> Column:
    """The generalised path."""
    return F.regexp_replace(path, r"[0-9]+", "{n}")


def _branches(child: DataFrame) -> DataFrame:
    """Of the children (host, prefix, seg, n, lab, good) of each branch, those
    that stand alone, with the name of the merged branch that they belong to."""
    node = ["host", "prefix"]
    parent = child.groupBy(*node).agg(F.sum("lab").alias("p_lab"), F.sum("good").alias("p_good"))
    rate = F.col("p_good") / F.col("p_lab")
    gap = F.abs(F.col("good") - F.col("lab") * rate)
    # a branch stands alone when its good labels are too far from what the parent's rate gives
    stands = (F.col("lab") > 0) & (F.col("p_lab") > 0) & (
        gap * gap > Z_DIFFERENT * Z_DIFFERENT * F.col("lab") * rate * (1 - rate)) & (gap > 0)
    alone = child.where((F.col("n") >= MIN_URLS) & (F.col("seg") != "")).join(parent, node).where(stands)
    # branches of equal counts are alike; classes of them are merged with the class before in order of purity
    order = Window.partitionBy(*node).orderBy(F.col("good") / F.col("lab"), "lab")
    lab, good = F.col("lab").cast("double"), F.col("good").cast("double")
    lab0, good0 = F.lag(lab).over(order), F.lag(good).over(order)
    far = good * lab0 - good0 * lab
    pooled = (good + good0) * ((lab + lab0) - (good + good0))
    differs = far * far * (lab + lab0) > Z_DIFFERENT * Z_DIFFERENT * pooled * lab * lab0
    classes = (alone.groupBy(*node, "lab", "good").agg(F.min("seg").alias("first"), F.count(F.lit(1)).alias("size"))
               .withColumn("cut", F.coalesce(differs, F.lit(True)).cast("int"))
               .withColumn("branch", F.sum("cut").over(order)))
    whole = Window.partitionBy(*node, "branch")
    first, more = F.min("first").over(whole), F.sum("size").over(whole) - 1
    name = F.when(more == 0, first).otherwise(F.concat(F.lit("{"), first, F.lit("+"), more.cast("string"), F.lit("}")))
    return alone.join(classes.select(*node, "lab", "good", name.alias("name")), [*node, "lab", "good"]) \
        .select(*node, "seg", "name")


def template_tree(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """From ``urls`` (host, shape, label_id) and ``labels`` (label_id, good)
    one row per distinct generalised path: host, shape, template, n_urls,
    n_labelled, n_good, rejected."""
    shape = ["host", "shape"]
    good = labels.groupBy("label_id").agg(F.min("good").alias("good"))
    marked = (urls.where(F.col("label_id").isNotNull()).join(good, "label_id").groupBy(*shape)
              .agg(F.count(F.lit(1)).alias("lab"), F.sum("good").alias("good")))
    paths = cut_lineage(urls.groupBy(*shape).agg(F.count(F.lit(1)).alias("n"))
                        .join(marked, shape, "left").na.fill(0, ["lab", "good"]))
    sums = (F.sum("n").alias("n"), F.sum("lab").alias("lab"), F.sum("good").alias("good"))
    mixed = (F.col("n") >= MIN_URLS) & (F.col("good") > 0) & (F.col("good") < F.col("lab"))

    parts = F.filter(F.split("shape", "/"), lambda p: p != "")
    paths = paths.withColumn("parts", parts)
    grown, level = paths.withColumn("prefix", F.lit("")), 1
    while True:
        # a branch of one path has nothing to tell apart
        live = grown.groupBy("host", "prefix").agg(*sums, F.count(F.lit(1)).alias("paths"), F.max(F.size("parts")).alias("segments"))
        if not live.where(mixed & (F.col("paths") > 1) & (F.col("segments") >= level)).limit(1).count():
            break
        grown = grown.withColumn("seg", F.coalesce(F.get("parts", F.lit(level - 1)), F.lit("")))
        child = cut_lineage(grown.groupBy("host", "prefix", "seg").agg(*sums))
        step = F.when(F.col("seg") == "", F.lit("")).otherwise(F.concat(F.lit("/"), F.coalesce("name", F.lit("*"))))
        grown = cut_lineage(grown.join(_branches(child), ["host", "prefix", "seg"], "left")
                            .withColumn("prefix", F.concat("prefix", step)).drop("name", "seg"))
        level += 1
    deeper = F.greatest(F.size("parts") - (level - 1), F.lit(0))
    tree = grown.select(*shape, "n", "lab", "good", F.concat("prefix", F.repeat(F.lit("/*"), deeper)).alias("template"))
    leaf = tree.groupBy("host", "template").agg(*[F.sum(c).alias(f"n_{c}") for c in ("n", "lab", "good")])
    total = paths.agg(F.sum("good").alias("g"), F.sum("lab").alias("l")).first()
    prior = total["g"] / total["l"] if total["l"] else 1.0
    purity = (F.col("n_good") + F.lit(SMOOTHING) * F.lit(float(prior))) / (F.col("n_lab") + F.lit(SMOOTHING))
    judged = (leaf.select(
        "host", "template", F.col("n_n").alias("n_urls"), F.col("n_lab").alias("n_labelled"), "n_good",
        (purity < MIN_PURITY).alias("rejected")))
    return tree.select(*shape, "template").join(judged, ["host", "template"])


def url_filter(urls: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """Per row of ``urls`` (page_id, url, label_id): page_id, host, path, rule,
    verdict, template, n_urls, n_labelled, n_good. ``labels``: label_id, good (0/1)."""
    host, path = url_parts(F.col("url"))
    d = narrow(urls, {"page_id": "long", "url": "string", "label_id": "long"}).select(
        "page_id", "label_id", host.alias("host"), path.alias("path"))
    d = d.withColumn("shape", _shape(F.col("path")))
    tree = template_tree(d, narrow(labels, {"label_id": "long", "good": "int"}).where(F.col("good").isNotNull()))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    return d.join(tree, ["host", "shape"]).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template", "n_urls", "n_labelled", "n_good")


# query --------------------------------------------------------------------
def op2_url_filters(spark, sf_dir: str) -> DataFrame:
    """All pages. A page's label is that of the document whose number its path ends in."""
    number = F.regexp_extract(url_parts(F.col("url"))[1], r"([0-9]{1,18})[^0-9]*$", 1)
    urls = table(spark, sf_dir, "pages").select("page_id", "url", number.try_cast("long").alias("label_id"))
    good = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_id"), F.col("quality").alias("good"))
    return url_filter(urls, good)


#: Levels of the SQL, which has no loop over them: it holds for paths of up to so many segments.
DEPTH = 3
LEVELS = [f"s{i + 1}" for i in range(DEPTH)]


def _sql() -> str:
    segs = ",\n".join(f"coalesce(p[{i + 1}], '') AS s{i + 1}" for i in range(DEPTH))
    keys = "host, " + ", ".join(LEVELS) + ", tail"
    steps, prev = [], "t0"
    for i, s in enumerate(LEVELS):
        t = f"t{i + 1}"
        steps.append(f"""
c{i} AS (SELECT host, prefix, {s}, sum(n) AS n, sum(lab) AS lab, sum(good) AS good FROM {prev} GROUP BY ALL),
q{i} AS (SELECT host, prefix, sum(lab) AS p_lab, sum(good)::DOUBLE / sum(lab) AS r FROM c{i} GROUP BY ALL),
a{i} AS (SELECT c.* FROM c{i} c JOIN q{i} q ON c.host = q.host AND c.prefix = q.prefix
         WHERE n >= {MIN_URLS} AND {s} <> '' AND lab > 0 AND p_lab > 0 AND abs(good - lab * r) > 0
           AND abs(good - lab * r) * abs(good - lab * r) > {Z_DIFFERENT}::DOUBLE * {Z_DIFFERENT}::DOUBLE * lab * r * (1 - r)),
o{i} AS (SELECT host, prefix, lab::DOUBLE AS lab, good::DOUBLE AS good, min({s}) AS first, count(*) AS size,
           lag(lab::DOUBLE) OVER w AS lab0, lag(good::DOUBLE) OVER w AS good0
         FROM a{i} GROUP BY host, prefix, lab, good WINDOW w AS (PARTITION BY host, prefix ORDER BY good / lab, lab)),
b{i} AS (SELECT *, sum(CASE WHEN lab0 IS NULL OR (good * lab0 - good0 * lab) * (good * lab0 - good0 * lab) * (lab + lab0)
             > {Z_DIFFERENT}::DOUBLE * {Z_DIFFERENT}::DOUBLE * ((good + good0) * ((lab + lab0) - (good + good0))) * lab * lab0
             THEN 1 ELSE 0 END) OVER (PARTITION BY host, prefix ORDER BY good / lab, lab) AS branch FROM o{i}),
m{i} AS (SELECT host, prefix, branch, min(first) AS first, sum(size) - 1 AS more FROM b{i} GROUP BY ALL),
k{i} AS (SELECT a.host, a.prefix, a.{s}, CASE WHEN more = 0 THEN m.first ELSE '{{' || m.first || '+' || more || '}}' END AS name
         FROM a{i} a JOIN b{i} b ON a.host = b.host AND a.prefix = b.prefix AND a.lab = b.lab AND a.good = b.good
           JOIN m{i} m ON b.host = m.host AND b.prefix = m.prefix AND b.branch = m.branch),
{t} AS (SELECT t.* EXCLUDE (prefix), t.prefix || CASE WHEN t.{s} = '' THEN '' WHEN k.host IS NOT NULL THEN '/' || k.name ELSE '/*' END AS prefix
        FROM {prev} t LEFT JOIN k{i} k ON t.host = k.host AND t.prefix = k.prefix AND t.{s} = k.{s})""")
        prev = t
    fits = " ".join(
        f"WHEN (d.host = '{r.host}' OR suffix(d.host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{{{r.name}}}'"
        for r in sorted(RULES, key=lambda r: (-len(r.name), r.name)))
    name, verdict = fits, fits
    for r in RULES:
        name = name.replace(f"{{{r.name}}}", r.name)
        verdict = verdict.replace(f"{{{r.name}}}", r.verdict)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN url IS NOT NULL AND contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS x FROM pages),
h AS (SELECT page_id, translate(regexp_extract(x, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
v AS (SELECT *, try_cast(regexp_extract(path, '([0-9]{{1,18}})[^0-9]*$', 1) AS BIGINT) AS label_id,
             list_filter(string_split(regexp_replace(path, '[0-9]+', '{{n}}', 'g'), '/'), lambda x: x <> '') AS p FROM h),
d AS (SELECT page_id, host, path, label_id, {segs}, CASE WHEN len(p) > {DEPTH} THEN '/*' ELSE '' END AS tail FROM v),
g AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1),
t0 AS (SELECT {keys}, count(*) AS n, count(good) AS lab, coalesce(sum(good), 0) AS good, '' AS prefix
       FROM d LEFT JOIN g ON d.label_id = g.doc_id GROUP BY {keys}),{",".join(steps)},
leaf AS (SELECT host, prefix || tail AS template, sum(n)::BIGINT AS n_urls, sum(lab)::BIGINT AS n_labelled, sum(good)::BIGINT AS n_good
         FROM {prev} GROUP BY ALL),
prior AS (SELECT CASE WHEN sum(lab) > 0 THEN sum(good)::DOUBLE / sum(lab) ELSE 1.0 END AS pr FROM t0),
j AS (SELECT t.*, l.template, n_urls, n_labelled, n_good,
             (n_good + {SMOOTHING}::DOUBLE * pr) / (n_labelled + {SMOOTHING}::DOUBLE) < {MIN_PURITY} AS rejected
      FROM {prev} t JOIN leaf l ON t.host = l.host AND t.prefix || t.tail = l.template, prior)
SELECT page_id, d.host, path, CASE {name} END AS rule,
       CASE {verdict} ELSE CASE WHEN rejected THEN 'block' ELSE 'allow' END END AS verdict, template, n_urls, n_labelled, n_good
FROM d JOIN j ON d.host = j.host AND d.tail = j.tail AND {" AND ".join(f"d.{s} = j.{s}" for s in LEVELS)}"""


OP2_SQL = _sql()
