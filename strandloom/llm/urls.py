"""URL filtering: a list of rules first, then a path-template tree for each host.

Paths are cut into segments. Level by level, numbers become wildcards, rare segments below a node with many become one
wildcard, and labelled sibling branches whose share of bad pages cannot be told from that of their siblings are merged. A
template is rejected when its share of bad labelled pages, smoothed towards that of its parent, and that towards its
parent's up to a prior, is one half or more. Labels come from host words and from what the pages show, judged by a model of
labelled documents, so that branches of any host are rejected for their pages. All steps are aggregates over distinct
(host, path), so a host that holds a third of the pages meets no one task; a path that is alone below its node is done at
once, however deep it is.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import toxicity
from .common import dealt, discard, for_all, hot_keys, materialise

# Rules as (verdict, host and path), and host words that mark a page as bad for learning.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
BAD_WORDS = ["adult", "ads", "bets", "casino", "cheap", "farm", "pills", "porn", "spam", "track", "viagra", "warez", "win"]

#: A segment seen less often, below a node with more children than this, is a value and not a name.
RARE, MANY = 3, 12
#: Weight of the prior in pages, the prior share of bad pages, and the width of the test for merging.
WEIGHT, PRIOR, Z = 1.0, 0.2, 1.96
#: A page's text is bad from this score on.
BAD_TEXT = 0.5
#: A node with more than this share of all paths is hot.
HOT = 0.001

# What a reader of a page does not see: comments, scripts, styles and tags; one that is not closed reaches to the end.
_UNSEEN = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>]|\Z).*?(?:</\1(?=[\s/>]|\Z)[^>]*(?:>|\Z)|\Z)|</?[a-z!?][^>]*(?:>|\Z)")


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (else null) and its verdict; ties go to the rule that comes first by name."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: (-len(x[1]), x[1]), reverse=True):
        h, slash, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        name, verdict = F.when(fits, F.lit(r)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def seed_label(host: Column, words=BAD_WORDS) -> Column:
    """Labels where none is given: bad for hosts with a bad word as a part. Rules give none: they decide their own pages,
    and the branches that they name would speak for the rest of a host."""
    return F.when(F.arrays_overlap(F.split(host, "[.-]"), F.array(*map(F.lit, words))), 1)


def text_of(html: str | None) -> str:
    """What a page shows, tags as blanks."""
    return unescape(_UNSEEN.sub(" ", html or ""))


def bad_texts(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """What a page's text is judged by: learned from documents labelled toxic or of low quality against the other labelled ones."""
    bad = F.greatest(F.col("toxic").cast("int"), 1 - F.col("quality").cast("int"))
    return toxicity.train(docs, labels.select("doc_id", bad.alias("bad")), label="bad")


def judge_by_texts(pages: DataFrame, model: toxicity.Model, rules=RULES, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """judge() with labels from the pages themselves: bad if the model finds a page's text bad or its host has a bad word, else
    good; a page without words is labelled by a bad host word only. Every page's whole text is read, once.
    """
    read = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    marked = materialise(toxicity.mark(read, model, "html", "bad", text_of, BAD_TEXT), "pages")
    return judge(marked, rules, F.greatest("bad", seed_label(host_of(F.col("url")))))


def _shape(segment: Column) -> Column:
    """A segment with numbers as {n} and hexadecimal runs as {hex}; a literal one of *, + or braces is escaped by a backslash."""
    plain = F.regexp_replace(segment, r"([\\{}*+])", r"\\$1")
    return F.regexp_replace(F.regexp_replace(plain, r"(?i)\b(?=[0-9a-f]*[0-9])[0-9a-f]{8,}\b", "{hex}"), r"[0-9]+", "{n}")


def templates(paths: DataFrame) -> DataFrame:
    """paths (host, path, n, lab, bad) with the template of each and its purity: the tree, built level by level.

    purity: the share of bad pages of the template, smoothed by the parent's with WEIGHT pages, and so on up to PRIOR.
    """
    shapes = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), _shape)
    tree = paths.withColumns({"segs": shapes, "template": F.lit("")})
    hosts = paths.groupBy("host").agg(_purity(F.sum("lab"), F.sum("bad"), F.lit(PRIOR)).alias("purity"), F.count("*").alias("rows"))
    tree = materialise(_met(tree, hosts, ["host"]), "paths")
    done, level = [], 0
    while True:  # one turn a level
        at = F.lit(level)
        done.append(tree.where(F.size("segs") <= level).drop("segs"))
        tree = tree.where(F.size("segs") > level).withColumn("shape", F.get("segs", at))
        kids = tree.groupBy("host", "template", "shape").agg(F.max("purity").alias("above"), F.count("*").alias("rows"), *(F.sum(c).alias(c) for c in ("n", "lab", "bad")))
        nodes = kids.groupBy("host", "template").agg(F.count("*").alias("kids"), F.sum("rows").alias("paths"), F.sum("lab").alias("all_lab"), F.sum("bad").alias("all_bad"))
        share = lambda bad, lab: (bad + 0.5) / (lab + 1)
        others, all_ = [F.col(f"all_{c}") - F.col(c) for c in ("bad", "lab")], share(F.col("all_bad"), F.col("all_lab"))
        spread = F.sqrt(all_ * (1 - all_) * (1 / (F.col("lab") + 1) + 1 / (others[1] + 1)))
        alike = F.abs(share(F.col("bad"), F.col("lab")) - share(*others)) <= Z * spread
        name = (
            F.when((F.col("n") < RARE) & (F.col("kids") > MANY), F.lit("/*"))
            .when((F.col("lab") > 0) & (others[1] > 0) & alike, F.lit("/+"))
            .otherwise(F.concat(F.lit("/"), "shape"))
        )
        named = kids.join(nodes, ["host", "template"]).withColumns({"name": name, "alone": F.col("paths") == 1})
        named = materialise(named.select("host", "template", "shape", "above", "rows", "lab", "bad", "name", "alone"), "branches")
        if named.isEmpty():
            discard(named)
            break
        own = named.groupBy("host", "template", "name").agg(_purity(F.sum("lab"), F.sum("bad"), F.max("above")).alias("purity"))
        named = materialise(named.drop("above", "lab", "bad").join(own, ["host", "template", "name"]), "branches")
        tree = _met(tree.drop("purity"), named, ["host", "template", "shape"]).withColumn("template", F.concat("template", "name"))
        tree = materialise(tree.drop("name", "shape"), "paths")
        rest = F.slice("segs", level + 2, F.greatest(F.size("segs"), F.lit(1)))
        steps, known = F.size(rest), F.col("bad") / F.greatest("lab", F.lit(1))
        tail = F.when(F.size(rest) > 0, F.concat(F.lit("/"), F.array_join(rest, "/"))).otherwise("")
        deeper = F.when(F.col("lab") > 0, known + (F.col("purity") - known) * F.pow(WEIGHT / (F.col("lab") + WEIGHT), steps)).otherwise(F.col("purity"))
        done.append(tree.where("alone").withColumns({"template": F.concat("template", tail), "purity": deeper}).drop("segs", "alone"))
        tree, level = tree.where("not alone").drop("alone"), level + 1
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def _purity(lab: Column, bad: Column, above: Column) -> Column:
    """The share of bad pages, smoothed by that of the node above."""
    return (bad + WEIGHT * above) / (lab + WEIGHT)


def _met(paths: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """paths with the columns of their node; the paths of a hot node (at most 1 / HOT of them) are dealt over several keys."""
    hot = hot_keys(nodes, keys, HOT)
    return dealt(paths, hot, keys, F.monotonically_increasing_id()).join(for_all(nodes.drop("rows"), hot, keys), [*keys, "part"]).drop("part")


def judge(pages: DataFrame, rules=RULES, label: Column | None = None, key: str = "page_id", url: str = "url") -> DataFrame:
    """For each row: page_id, host, path, rule, verdict, template and purity (share of bad pages, smoothed).

    label: 1 bad, 0 good, null unlabelled; by default bad host words give it. A null or malformed url has an
    empty host and path, no rule, and is judged as any other template. Urls may be as long and deep as they like. Repeated
    rows are judged alike. Other columns, whatever their names, are not read.
    """
    parsed = pages.select(F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), (F.lit(None) if label is None else label).cast("int").alias("given"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": rule, "ruled": verdict})
    known = F.coalesce("given", seed_label(F.col("host")))
    distinct = parsed.groupBy("host", "path").agg(F.count("*").alias("n"), F.count(known).alias("lab"), F.coalesce(F.sum(known), F.lit(0)).alias("bad"))
    by_path = templates(materialise(distinct, "paths")).select("host", "path", "template", "purity", F.col("n").alias("rows"))
    out = _met(parsed, by_path, ["host", "path"])
    learnt = F.when(F.col("purity") >= 0.5, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", learnt).alias("verdict"), "template", "purity")
