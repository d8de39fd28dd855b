"""URL verdicts from a tree of path templates: rules first, then the purity of a page's template.

A host's tree has a node for every beginning of its paths. Segments that vary by their look, or because most of a node's
children are met once only, are wildcards. Labels speak for their own template; where statistical generalisation or a
common ancestor carries them over to other branches, each labelled branch is one vote, however many pages it has, so that one
large rejected section doesn't speak for its siblings. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipledger.llm.support import discard, stage

#: Segments of a path that are nodes of their own; what follows them is one last segment.
DEPTH = 32
#: Turns of generalisation: a variable below a variable is found one turn later.
TURNS = 3
#: Pseudo-labels that pull a template's purity towards one half.
SMOOTHING = 2.0
#: Smoothed share of blocked pages from which on a template is rejected.
REJECT_AT = 0.8
#: Share of children met once from which on, to this many standard errors, a node's literal children are one variable.
ONCE, ONCE_Z = 0.5, 1.96
#: Two branches are similar if their shares of blocked pages differ by less than so many standard errors.
SIMILAR_Z = 1.96

_UPPER = "".join(map(chr, range(65, 91)))


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values.
RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if null or without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. A rule fits its host and all subdomains."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda one: (len(one.name), one.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def shapes(path: Column) -> Column:
    """The segments of a path with variable ones as wildcards by their look; an extension stays."""
    segments = F.filter(F.split(path, "/"), lambda part: part != "")
    # Numbers, then hex strings and UUIDs, then slugs that end in a number.
    number = F.transform(segments, lambda part: F.regexp_replace(part, r"^[0-9]+(?=$|\.)", "*"))
    digest = F.transform(number, lambda part: F.regexp_replace(part, r"^(?=.*[0-9])[0-9a-fA-F-]{8,}(?=$|\.)", "*"))
    return F.transform(digest, lambda part: F.regexp_replace(part, r"^[^.*]*[0-9]{3,}[^.]*(?=$|\.)", "*"))


def _bounded(look: Column) -> Column:
    """The first segments as they are, all others joined to one."""
    rest = F.array_join(F.slice(look, F.lit(DEPTH), F.greatest(F.size(look), F.lit(1))), "/")
    return F.when(F.size(look) > DEPTH, F.concat(F.slice(look, 1, DEPTH - 1), F.array(rest))).otherwise(look)


def _generalised(looks: DataFrame) -> DataFrame:
    """One turn: literal children become ``*`` where most of a node's literal children are met on one page only.

    "Most": the lower Wilson bound of their share is over ``ONCE``, so it takes several children to say so, and no
    number of them is special.
    """
    steps = looks.select("host", "look", "template", "pages", F.posexplode("template").alias("depth", "segment"))
    steps = steps.withColumn("parent", F.slice("template", F.lit(1), F.col("depth")))
    children = steps.where(~F.col("segment").startswith("*")).groupBy("host", "parent", "segment").agg(F.sum("pages").alias("pages"))
    k, share = F.count("*"), F.avg((F.col("pages") == 1).cast("double"))
    z = F.lit(ONCE_Z)
    lower = (share + z * z / (2 * k) - z * F.sqrt((share * (1 - share) + z * z / (4 * k)) / k)) / (1 + z * z / k)
    variable = children.groupBy("host", "parent").agg(lower.alias("lower")).where(F.col("lower") > ONCE)
    variable = variable.select("host", "parent", F.lit(True).alias("variable"))
    segment = F.when(F.col("variable") & ~F.col("segment").startswith("*"), F.lit("*")).otherwise(F.col("segment"))
    renamed = (
        steps.join(variable, ["host", "parent"], "left")
        .groupBy("host", "look")
        # As many entries as the template has segments.
        .agg(F.array_sort(F.collect_list(F.struct("depth", segment.alias("segment")))).alias("steps"))
        .select("host", "look", F.col("steps.segment").alias("renamed"))
    )
    return looks.join(renamed, ["host", "look"], "left").withColumn("template", F.coalesce("renamed", "template")).drop("renamed")


def templates(pages: DataFrame) -> DataFrame:
    """Per host and look: its template in the host's tree, and counts of pages, labelled and blocked pages.

    ``pages`` has host, look (segments from ``shapes``) and blocked (1, 0 or null if unlabelled). Pages
    are counted per look before anything is shuffled, so a host with most pages is a few rows. Counts are stored, and so is
    each turn: a turn reads the one before three times, and a plan of all turns would hold every one of them 27 times.
    """
    looks = (
        pages.groupBy("host", "look")
        .agg(F.count("*").alias("pages"), F.count("blocked").alias("labelled"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("bad"))
        .withColumn("template", _bounded(F.col("look")))
    )
    looks = stage(looks, "looks")
    for _ in range(TURNS):
        before, looks = looks, stage(_generalised(looks), "looks")
        discard(before)
    return looks.select("host", "look", "template", "pages", "labelled", "bad")


def template_purity(looks: DataFrame) -> DataFrame:
    """Per host and template: pages, labelled, bad, what counts after merging, purity, level and rejected.

    A template of one look counts its labelled pages; one that several looks were generalised to counts its labelled looks, each
    by its share of blocked pages. Templates that differ in their last literal segment only are siblings. A labelled one
    joins its siblings if its share differs from theirs by less than ``SIMILAR_Z`` standard errors; then all of the
    joined count together. Purity is (bad + 1) / (labelled + 2) of what counts.

    A template without labels takes the purity of its nearest ancestor that has labelled children: each child is a vote
    by its share. ``level`` is that ancestor's depth; null where the labels are the template's own, or where there are none: then
    purity is one half. A template is rejected from ``REJECT_AT`` on.
    """
    share = F.col("bad") / F.nullif(F.col("labelled"), F.lit(0))
    nodes = looks.groupBy("host", "template").agg(
        F.sum("pages").alias("pages"),
        F.sum("labelled").alias("labelled"),
        F.sum("bad").alias("bad"),
        F.count("*").alias("looks"),
        F.count(share).alias("votes"),
        F.coalesce(F.sum(share), F.lit(0.0)).alias("bad_votes"),
    )
    merged_looks = F.col("looks") > 1
    nodes = nodes.withColumn("n", F.when(merged_looks, F.col("votes")).otherwise(F.col("labelled")).cast("double")).withColumn(
        "x", F.when(merged_looks, F.col("bad_votes")).otherwise(F.col("bad")).cast("double")
    )
    literal = F.transform(F.col("template"), lambda part, at: F.when(~part.startswith("*"), at))
    last = F.array_max(literal)  # null if there is none
    nodes = nodes.withColumn(
        "family",
        F.when(
            last.isNotNull(),
            F.transform("template", lambda part, at: F.when(at == last, F.lit("\0")).otherwise(part)),
        ).otherwise(F.col("template")),
    )
    families = nodes.groupBy("host", "family").agg(F.sum("n").alias("all"), F.sum("x").alias("all_bad"))
    n, x = F.col("n"), F.col("x")
    rest, rest_x = F.col("all") - n, F.col("all_bad") - x
    pooled = F.col("all_bad") / F.nullif(F.col("all"), F.lit(0.0))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.nullif(n, F.lit(0.0)) + 1 / F.nullif(rest, F.lit(0.0))))
    gap = F.abs(x / F.nullif(n, F.lit(0.0)) - rest_x / F.nullif(rest, F.lit(0.0)))
    similar = F.coalesce((n > 0) & (rest > 0) & (gap <= SIMILAR_Z * error + 1e-12), F.lit(False))
    judged = nodes.join(families, ["host", "family"]).withColumn("similar", similar)
    merged = judged.where("similar").groupBy("host", "family").agg(F.sum("n").alias("m_n"), F.sum("x").alias("m_x"))
    counted = (
        judged.join(merged, ["host", "family"], "left")
        .withColumn("c_labelled", F.when(F.col("similar"), F.col("m_n")).otherwise(n))
        .withColumn("c_bad", F.when(F.col("similar"), F.col("m_x")).otherwise(x))
    )
    counted = counted.join(_ancestors(nodes), ["host", "template"], "left")
    own = F.col("c_labelled") > 0
    purity = (F.col("c_bad") + SMOOTHING / 2) / (F.col("c_labelled") + SMOOTHING)
    purity = F.when(own, purity).otherwise(F.coalesce(F.col("nearest.purity"), F.lit(0.5)))
    return counted.select(
        "host",
        "template",
        "pages",
        "labelled",
        "bad",
        F.col("c_labelled").alias("merged_labelled"),
        F.col("c_bad").alias("merged_bad"),
        purity.alias("purity"),
        F.when(~own, F.col("nearest.level")).alias("level"),
        (purity >= REJECT_AT).alias("rejected"),
    )


def _ancestors(nodes: DataFrame) -> DataFrame:
    """For templates without labels: level and purity of the nearest ancestor with labelled children."""

    def beginnings(rows: DataFrame, longest: Column) -> DataFrame:
        return rows.withColumn("level", F.explode(F.sequence(F.lit(0), longest))).withColumn(
            "node", F.slice("template", F.lit(1), F.col("level"))
        )

    labelled = nodes.where("labelled > 0 AND size(template) > 0")
    children = (
        beginnings(labelled, F.size("template") - 1)
        .groupBy("host", "node", F.element_at("template", F.col("level") + 1).alias("child"))
        .agg((F.sum("bad") / F.sum("labelled")).alias("share"))
    )
    votes = children.groupBy("host", "node").agg(
        ((F.sum("share") + SMOOTHING / 2) / (F.count("*") + SMOOTHING)).alias("node_purity")
    )
    return (
        beginnings(nodes.where("labelled = 0").select("host", "template"), F.size("template"))
        .join(votes, ["host", "node"])
        .groupBy("host", "template")
        .agg(F.max(F.struct("level", F.col("node_purity").alias("purity"))).alias("nearest"))
    )


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, label: str | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and template of every page.

    The longest fitting rule gives the verdict; a page without one is blocked if its template is
    rejected, else allowed. Templates learn from the verdicts of the rules, or from the column ``label`` (1 blocked, 0 not,
    null unknown) where it is given and not null. Null urls and those without ``://`` have empty host and path and are allowed
    unless labels reject that template. A url of any length is judged whole. Repeated rows and null page_ids each give a
    row; extra columns are ignored.
    """
    host, path = F.col("host"), F.col("path")
    given = F.col(label).cast("int") if label else F.lit(None).cast("int")
    parsed = (
        pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), given.alias("given"))
        .withColumn("matched", matched_rule(host, path, rules))
        .withColumn("look", shapes(path))
        .withColumn(
            "blocked",
            F.coalesce("given", F.when(F.col("matched").isNotNull(), (F.col("matched.verdict") == "block").cast("int"))),
        )
    )
    looks = templates(parsed)
    purity = template_purity(looks)
    verdicts = looks.join(purity.select("host", "template", "rejected"), ["host", "template"]).select(
        "host", "look", "template", "rejected"
    )
    return parsed.join(verdicts, ["host", "look"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("matched.rule").alias("rule"),
        F.coalesce(
            F.col("matched.verdict"),
            F.when(F.coalesce(F.col("rejected"), F.lit(False)), F.lit("block")).otherwise(F.lit("allow")),
        ).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
    )
