"""URL filters: allow and block rules, and a tree of path templates.

Per host the paths of pages form a tree of segments.  A segment that varies (it holds a digit, or
few pages of the host have it at that level) becomes a wildcard.  So does a branch whose share of
blocked labels is statistically like that of its node, and the branches of a node that are apart
from it but alike among themselves become one: such branches merge.  What is left are
templates.  A template is rejected if its labelled purity, shrunk towards its host's and that
towards the overall share, says so.

All prefixes of all paths are counted by one aggregation, so the jobs do not depend on how
deep the paths are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.staging import stage

#: So many rules are an expression of the query; more of them are a table that is joined.
RULES_IN_QUERY = 1000
#: Pages that a segment, and a branch, needs to be told apart.
MIN_PAGES = 3
#: Standard deviations from its node's share of blocked labels that part a branch.
APART = 1.64
#: Branches of a node are alike if their smoothed shares lie in the same of so many steps.
SHARES = 8
#: Labels that a template's host counts for, and a host's surroundings.
PRIOR_LABELS = 5.0
MAX_BLOCKED = 0.5
#: Keys that hold such a part of all rows of a join are sent to every task: so many at most, and
#: their strings at most so many times the mean of a row.
HOT = 10_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_FOUND = "struct<length:int,host_length:int,verdict:string,rule:string>"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _key(*parts: Column | str) -> Column:
    """128 bits that stand for the parts.  A host holds no ``/`` and what follows it starts with
    one, so that parts end to end are not ambiguous."""
    return F.unhex(F.md5(F.concat(*parts)))


def _spread_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The inner join of ``left`` with ``right``, whose keys are distinct and whose ``n`` is at
    least the number of the left side's rows with that key.

    A key with a HOT-th of all rows is joined where its rows lie; only others are shuffled.
    """
    total = right.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT >= total
    hot, others = right.where(is_hot).drop("n"), right.where(~is_hot).drop("n")
    cold = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(others, key)
    return left.join(F.broadcast(hot), key).unionByName(cold)


def _counted_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    left = stage(left)
    counts = left.groupBy(key).agg(F.count("*").alias("n"))
    return _spread_join(left, stage(right.join(counts, key)), key)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of the rules ``(verdict, host/path)`` that fits, as a struct with ``rule`` and
    ``verdict``, or NULL.  Of equally long ones that with the longer host counts, and then block."""
    fitting = []
    for verdict, rule in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks: {verdict}")
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(slash + rest)
        found = F.struct(
            F.lit(len(rule)).alias("length"),
            F.lit(len(rule_host)).alias("host_length"),
            F.lit(verdict).alias("verdict"),
            F.lit(rule).alias("rule"),
        )
        fitting.append(F.when(fits, found))
    if not fitting:
        return F.lit(None).cast(_FOUND)
    return F.array_max(F.array(*fitting))


def with_rules(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """``paths`` (key, host, path) with ``found``, as :func:`matched_rule` gives it, by a table of
    rules ``verdict, rule`` of any size.

    Every host that a path's host ends with is looked up, and of its rules those whose path
    is the path's beginning, for each length that occurs.  NULL rules and verdicts other than
    allow and block are an error of the job.
    """
    rule_host = F.substring_index("rule", "/", 1)
    valid = F.expr(
        "IF(rule IS NOT NULL AND coalesce(verdict IN ('allow', 'block'), false), rule,"
        " raise_error(concat('not a rule: ', coalesce(verdict, 'NULL'), ' ', coalesce(rule, 'NULL'))))"
    )
    listed = stage(
        rules.select(valid.alias("rule"), "verdict")
        .groupBy("rule")
        .agg(F.max("verdict").alias("verdict"))
        .select("rule", "verdict", rule_host.alias("rule_host"))
        .withColumn("rest", F.expr("substring(rule, length(rule_host) + 1)"))
    )
    lengths = listed.groupBy("rule_host").agg(F.collect_set(F.length("rest")).alias("lengths"))
    ends = paths.select("key", "path", F.split("host", "[.]").alias("labels")).select(
        "key",
        "path",
        F.explode(
            F.expr("transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))")
        ).alias("rule_host"),
    )
    tried = _counted_join(ends, lengths, "rule_host").select(
        "key", "rule_host", "path", F.explode(F.expr("filter(lengths, x -> x <= length(path))")).alias("taken")
    )
    tried = tried.select("key", _key("rule_host", F.expr("substring(path, 1, taken)")).alias("rule_key"))
    found = F.struct(
        F.length("rule").alias("length"), F.length("rule_host").alias("host_length"), "verdict", "rule"
    )
    fitting = _counted_join(
        tried, listed.select(_key("rule_host", "rest").alias("rule_key"), found.alias("found")), "rule_key"
    )
    return paths.join(fitting.groupBy("key").agg(F.max("found").alias("found")), "key", "left")


def path_templates(paths: DataFrame) -> DataFrame:
    """``paths`` (key, host, path, pages, labelled, blocked; one row for a key) with ``template``.

    First, segments that vary become ``*``; a segment ``*`` of a path is one of these.  Then
    every prefix of the paths so written is a branch of the prefix before it, its node.  A branch
    of MIN_PAGES or more whose blocked labels are APART deviations or more from its node's
    smoothed share keeps its segment, and others become ``*``.  Kept branches of one node
    with alike shares are named after the least of them and how many others there are, ``{blog+2}``.

    A path of n segments is n rows of 16-byte keys; the work for those keys grows with n times
    the path's length.
    """
    cut = paths.withColumn("segments", F.split(F.btrim(F.col("path"), F.lit("/")), "/"))
    parts = stage(
        cut.select("key", "host", "pages", F.posexplode("segments").alias("level", "segment"))
        .where("NOT segment RLIKE '[0-9]' AND segment <> '*'")
        .select("key", "pages", "level", _key("host", F.lit("/"), "level", F.lit("/"), "segment").alias("part"))
    )
    common = (
        parts.groupBy("part")
        .agg(F.sum("pages").alias("pages"), F.count("*").alias("n"))
        .where(F.col("pages") >= MIN_PAGES)
        .select("part", "n")
    )
    kept = _spread_join(parts, stage(common), "part").groupBy("key").agg(F.collect_list("level").alias("kept"))
    written = stage(
        cut.join(kept, "key", "left").withColumn(
            "segments", F.expr("transform(segments, (s, i) -> IF(array_contains(kept, i), s, '*'))")
        )
    )
    joined = F.concat(F.lit("/"), F.array_join("segments", "/"))
    prefixes = (
        written.select("key", "host", "segments", "pages", "labelled", "blocked", joined.alias("joined"))
        .withColumn(
            "prefixes",
            F.expr(
                "transform(sequence(1, size(segments) + 1),"
                " i -> unhex(md5(concat(host, substring_index(joined, '/', i)))))"
            ),
        )
        .select(
            "*",
            F.posexplode(
                F.expr(
                    "transform(prefixes, (p, i) -> struct(p AS branch, IF(i = 0, NULL, prefixes[i - 1]) AS node,"
                    " IF(i = 0, NULL, nullif(segments[i - 1], '*')) AS segment))"
                )
            ).alias("level", "at"),
        )
        .select("key", "level", "at.*", "pages", "labelled", "blocked")
    )
    prefixes = stage(prefixes)
    counted = stage(
        prefixes.groupBy("branch", "node", "segment").agg(
            F.count("*").alias("n"), *(F.sum(c).alias(c) for c in ("pages", "labelled", "blocked"))
        )
    )
    nodes = counted.where("blocked > 0 AND blocked < labelled").select(
        F.col("branch").alias("node"), F.expr("(blocked + 1) / (labelled + 2)").alias("share"), "n"
    )
    branches = counted.where(f"segment IS NOT NULL AND pages >= {MIN_PAGES} AND labelled > 0")
    apart = f"abs(blocked - labelled * share) > {APART}D * sqrt(labelled * share * (1 - share))"
    step = F.expr(f"floor({SHARES} * ((blocked + 1) / (labelled + 2)))")
    parted = stage(
        _spread_join(branches.withColumnRenamed("n", "paths"), stage(nodes), "node")
        .where(apart)
        .select("branch", "segment", "paths", F.concat("node", step.cast("string").cast("binary")).alias("alike"))
    )
    alike = parted.groupBy("alike").agg(F.min("segment").alias("least"), F.count("*").alias("n"))
    name = F.when(F.col("others") == 0, F.col("least")).otherwise(
        F.concat(F.lit("{"), "least", F.lit("+"), "others", F.lit("}"))
    )
    named = _spread_join(parted, stage(alike.withColumn("others", F.col("n") - 1)), "alike").select(
        "branch", name.alias("name"), F.col("paths").alias("n")
    )
    names = (
        _spread_join(prefixes.select("key", "level", "branch"), stage(named), "branch")
        .groupBy("key")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col("level") - 1, "name"))).alias("names"))
    )
    template = F.expr("concat('/', array_join(transform(segments, (s, i) -> coalesce(names[i], '*')), '/'))")
    return written.join(names, "key", "left").select(*paths.columns, template.alias("template"))


def template_verdicts(templated: DataFrame, max_blocked: float = MAX_BLOCKED) -> DataFrame:
    """``template_key, labelled, purity, verdict`` of every template, and ``n``, its paths.

    ``template_key`` stands for host and template; ``purity`` is the smoothed share of blocked labels.
    """
    host_key = F.unhex(F.md5("host"))
    templates = stage(
        templated.groupBy(_key("host", "template").alias("template_key"), host_key.alias("host_key")).agg(
            F.count("*").alias("paths"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
        )
    )
    hosts = stage(
        templates.groupBy("host_key").agg(
            F.sum("labelled").alias("host_labelled"),
            F.sum("blocked").alias("host_blocked"),
            F.count("*").alias("n"),
        )
    )
    total = hosts.agg(F.sum("host_labelled").alias("n"), F.sum("host_blocked").alias("b")).first()
    share = ((total["b"] or 0) + 1) / ((total["n"] or 0) + 2)
    shrunk = f"(host_blocked + {PRIOR_LABELS}D * {share!r}D) / (host_labelled + {PRIOR_LABELS}D)"
    return (
        _spread_join(templates, hosts, "host_key")
        .selectExpr(
            "template_key",
            "labelled",
            f"(blocked + {PRIOR_LABELS}D * ({shrunk})) / (labelled + {PRIOR_LABELS}D) AS purity",
            "paths AS n",
        )
        .withColumn("verdict", F.when(F.col("purity") > max_blocked, "block").otherwise("allow"))
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] | DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    label_col: str | None = None,
) -> DataFrame:
    """``id_col, host, path, rule, verdict, template, purity`` of each row of ``pages``.

    ``rules`` are pairs of verdict and rule, or a table ``verdict, rule``; both give the same rows.
    The longest fitting rule gives the verdict, and where none fits the page's template does.
    Labels (1 block, 0 allow) are those of ``label_col``, or else the rules' own verdicts.
    A NULL url, or one without ``://``, has an empty host and path, which form a template of
    their own; repeated rows are judged each; an empty table gives no rows; other columns are not
    read.  Very long urls are read whole.  Ties between rules fall to the longer host, then to block.
    """
    url = F.col(f"`{url_col}`")
    split = stage(
        pages.select(
            F.col(f"`{id_col}`").alias("__id"),
            url_host(url).alias("host"),
            url_path(url).alias("path"),
            (F.col(f"`{label_col}`").cast("int") if label_col else F.lit(None).cast("int")).alias("label"),
        ).withColumn("key", _key("host", "path"))
    )
    paths = split.groupBy("key", "host", "path").agg(
        F.count("*").alias("pages"), F.count("label").alias("labelled"), F.count_if(F.col("label") == 1).alias("blocked")
    )
    if not isinstance(rules, DataFrame) and len(rules) > RULES_IN_QUERY:
        rules = pages.sparkSession.createDataFrame(list(rules), "verdict string, rule string")
    if isinstance(rules, DataFrame):
        paths = with_rules(stage(paths), rules)
    else:
        paths = paths.withColumn("found", matched_rule(F.col("host"), F.col("path"), rules))
    if not label_col:
        by_rule = F.col("found.verdict")
        paths = paths.withColumn("labelled", F.when(by_rule.isNotNull(), F.col("pages")).otherwise(0)).withColumn(
            "blocked", F.when(by_rule == "block", F.col("pages")).otherwise(0)
        )
    templated = stage(path_templates(stage(paths)).withColumn("template_key", _key("host", "template")))
    judged = stage(template_verdicts(templated).selectExpr("template_key", "purity", "verdict AS by_template", "n"))
    of_path = _spread_join(
        templated.selectExpr("key", "found.rule", "found.verdict", "template", "template_key", "pages"),
        judged,
        "template_key",
    ).withColumnRenamed("pages", "n")
    return _spread_join(split.drop("label"), stage(of_path.drop("template_key")), "key").select(
        F.col("__id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", "by_template").alias("verdict"),
        "template",
        "purity",
    )
