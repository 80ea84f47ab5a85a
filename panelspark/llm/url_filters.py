"""URL filters: fixed rules by host suffix and path prefix, and rules mined by FP-growth over URL tokens."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_counted, stored

#: Labelled rows that rules are mined from, about; deviations by which a rule must beat its verdict's base rate.
MINED_ROWS, MIN_Z = 200_000, 4.0
BAD, GOOD = "label=block", "label=allow"


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, with A-Z in lower case; '' without ://."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host, up to ? or #; '' without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_matches(host: Column, path: Column, rule: str) -> Column:
    """A rule `host/path`: the host itself or a subdomain of it, and a path that starts with the rule's."""
    own, _, rest = rule.partition("/")
    return ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest matching rule and its verdict (null if none), rules being {rule: verdict}."""
    order = sorted(rules, key=lambda r: (-len(r), r))
    rule = F.coalesce(*[F.when(rule_matches(host, path, r), F.lit(r)) for r in order], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(rule == r, F.lit(rules[r])) for r in order], F.lit(None).cast("string"))
    return rule, verdict


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct items of a URL: host labels, words of labels that have several, path segments without numbers."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    several = F.filter(F.split(host, r"\."), lambda x: x.contains("-"))
    words = F.transform(F.flatten(F.transform(several, lambda x: F.split(x, "-"))), lambda x: F.concat(F.lit("w:"), x))
    parts = F.transform(F.filter(F.split(F.regexp_replace(path, "[0-9]+", "0"), "/"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, words, parts))


def mine_rules(urls: DataFrame, min_support: float = 0.005, min_lift: float = 1.1, min_z: float = MIN_Z, min_rows: int = 12, rows: int = MINED_ROWS) -> DataFrame:
    """Association rules (antecedent array, verdict, confidence, lift, support) from rows (host, path, label).

    label is 'block' or 'allow'. Spark's FP-growth runs over about `rows` labelled rows, those whose hashes are under
    a cut. Pruned are itemsets under min_support (and under min_rows rows, which tell nothing), and rules whose
    confidence is not min_lift times the share that their verdict has at large, or lies under min_z deviations above
    it: most bad pages stand among good ones, so a bound on confidence itself would let no rule for them pass. A rule
    that a shorter one with the same verdict and at least its confidence implies is left out."""
    items = urls.where("label is not null and host <> ''").select(F.concat(url_tokens(F.col("host"), F.col("path")), F.array(F.concat(F.lit("label="), F.col("label")))).alias("items"), "host", "path")
    known = items.count()
    if known > rows:
        items = items.where(F.pmod(F.xxhash64("host", "path"), F.lit(1 << 30)) < int((1 << 30) * rows / known))
    sample = stored(items.select("items"), "labelled")
    n = sample.count()
    rules = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_rows / max(1, n))), minConfidence=0.01).fit(sample).associationRules
    rules = rules.where(F.element_at("consequent", 1).isin(BAD, GOOD) & ~F.array_contains("antecedent", BAD) & ~F.array_contains("antecedent", GOOD))
    base = F.col("confidence") / F.col("lift")
    deviation = F.sqrt(base * (1 - base) / (F.col("support") / F.col("confidence") * n))
    rules = rules.where((F.col("lift") >= min_lift) & (F.col("confidence") - base >= min_z * deviation))
    rules = rules.select(F.array_sort("antecedent").alias("antecedent"), F.regexp_replace(F.element_at("consequent", 1), "label=", "").alias("verdict"), "confidence", "lift", "support")
    rules = stored(rules, "rules")
    short = rules.select(F.element_at("antecedent", 1).alias("item"), F.col("antecedent").alias("a"), F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    implied = (F.size("a") < F.size("antecedent")) & (F.col("v") == F.col("verdict")) & (F.col("c") >= F.col("confidence")) & (F.size(F.array_except("a", "antecedent")) == 0)
    longer = rules.select("*", F.explode("antecedent").alias("item")).join(short, "item").where(implied).select("antecedent", "verdict").distinct()
    return rules.join(longer, ["antecedent", "verdict"], "left_anti")


def judge_urls(pages: DataFrame, rules: dict[str, str], labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", default: str = "allow", **mining) -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence) for every row of pages.

    A fixed rule decides where one fits, the longest first. Else the mined rules do: each stands in an inverted index
    under its rarest item, a URL's items look their candidates up, a candidate counts if the URL has all its items,
    and the one with the highest lift (then confidence, the most items, block) decides. Without one: `default`.

    Labels: `labels` rows (page_id, label) where given, else each URL that a fixed rule decides. Null URLs and URLs
    without :// have an empty host and path and get the default. URLs of any length are taken whole. Repeated ids keep
    their rows; other columns are ignored; an empty table gives no rows."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "fixed": verdict})
    known = rows.select("host", "path", F.col("fixed").alias("label")) if labels is None else rows.join(labels, "page_id").select("host", "path", "label")
    mined = mine_rules(known, **mining)
    # one look-up per distinct (host, path without numbers): pages of a hot host share it
    shaped = rows.withColumn("shape", F.regexp_replace("path", "[0-9]+", "0"))
    shape = stored(shaped.where("rule is null and host <> ''").groupBy("host", "shape").agg(F.count("*").alias("n")), "shapes").withColumn("items", url_tokens(F.col("host"), F.col("shape")))
    each = shape.select("host", "shape", "n", "items", F.explode("items").alias("item"))
    used = each.groupBy("item").agg(F.count("*").alias("df"))
    mined = mined.withColumn("id", F.sha2(F.concat_ws("|", "antecedent", "verdict"), 256))
    about = ["id", "antecedent", "verdict", "confidence", "lift"]
    index = mined.select(*about, F.explode("antecedent").alias("item")).join(used, "item")
    index = index.groupBy(*about).agg(F.min_by("item", F.struct("df", "item")).alias("item"))
    hits = each.join(index, "item").where(F.size(F.array_except("antecedent", "items")) == 0)
    best = hits.groupBy("host", "shape", "n").agg(F.max(F.struct("lift", "confidence", F.size("antecedent").alias("size"), "verdict")).alias("best"))
    out = join_counted(shaped, stored(best, "best"), ["host", "shape"], "n", "left").withColumn("best", F.when(F.col("rule").isNull(), F.col("best")))
    return out.select("page_id", "host", "path", "rule", F.coalesce("fixed", "best.verdict", F.lit(default)).alias("verdict"), F.col("best.confidence").alias("confidence"))
