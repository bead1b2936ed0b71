"""URL filter by association rules.

Host and path rules decide what they fit. The urls they decide are the labelled examples: FP-growth mines
combinations of url tokens that go with a verdict, rules below a support or confidence are left out, and so
is a rule when dropping one of its tokens gives a rule at least as sure. The other urls are judged by the surest mined rule
whose tokens they all have; without one, the verdict is ``DEFAULT``.

Tokens below the support are in no rule and are left out before mining. Tokens that the decided urls have in the
same places (parts of one template, labels of one host) are one item: a rule with the item stands for the rules with any of its
tokens, and the combinations among them are never formed. The tokens of an item are those with the same count and
the same two 64-bit sums of the hashes of their urls.

Matching uses an inverted index: a mined rule is filed under its rarest item, urls look it up by an equi-join
on their items, and the candidates are checked for the rest. Urls with equal token sets are judged once, so
neither a hot host nor a hot token multiplies the work.

Defined cases: a null url, and one without ``://``, has an empty host and path, fits no rule and has no tokens;
of rules of equal length the one named first wins; repeated rows are judged alike; other columns are left alone.
Without decided urls nothing is mined and ``DEFAULT`` stands.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.llm.registry import query
from millrace.session import settle

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
LEAST_SUPPORT = 0.01
LEAST_CONFIDENCE = 0.7
DEFAULT = "allow"
VERDICT = "verdict="


def _rest(url: str) -> Column:
    """What follows the first ``://``, empty without one."""
    url = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: str) -> Column:
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def path_of(url: str) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: str, path: str, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, else null."""
    kind = "struct<rule:string,verdict:string>"
    out = F.lit(None).cast(kind)
    for verdict, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        domain, slash, prefix = rule.partition("/")
        fits = (F.col(host) == domain) | F.col(host).endswith("." + domain)
        fits = fits & F.col(path).startswith(slash + prefix)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: str, host: str, path: str) -> Column:
    """The distinct tokens: labels of the host, parts of the path, names of parameters, a fragment.

    Runs of digits count as one sign, so that numbers do not make every url unique.
    """
    tagged = lambda tag, parts: F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(tag), p))
    numbers = lambda c: F.regexp_replace(c, "[0-9]+", "#")
    labels = tagged("host:", F.split(numbers(F.col(host)), r"\."))
    parts = tagged("path:", F.split(numbers(F.col(path)), r"[/.]"))
    asked = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    names = tagged("query:", F.transform(F.split(asked, "&"), lambda p: numbers(F.regexp_extract(p, "^([^=]*)", 1))))
    fragment = F.when(F.contains(_rest(url), F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(labels, parts, names, fragment)))


def items_of(labelled: DataFrame, least_support: float = LEAST_SUPPORT) -> DataFrame:
    """(token, item) of the tokens at the support; an item is the smallest of the tokens that occur in the same rows.

    A token at the support is in that share of the rows, so there are at most (mean tokens of a row / support) of them.
    """
    least = labelled.agg(F.count("*") * F.lit(least_support)).scalar()
    sets = labelled.groupBy("tokens").agg(F.count("*").alias("n"))
    places = [F.bit_xor(F.xxhash64(F.lit(k), "tokens")).alias(f"place{k}") for k in (1, 2)]
    uses = sets.select("tokens", "n", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum("n").alias("n"), *places)
    together = Window.partitionBy("n", "place1", "place2")
    return settle(uses.filter(F.col("n") >= least).select("token", F.min("token").over(together).alias("item")), "items")


def with_items(token_sets: DataFrame, items: DataFrame) -> DataFrame:
    """(tokens, items) of the distinct token sets that hold an item; sets must not repeat."""
    met = token_sets.select("tokens", F.explode("tokens").alias("token")).join(items, "token")
    return met.groupBy("tokens").agg(F.array_sort(F.collect_set("item")).alias("items"))


def mined_rules(
    labelled: DataFrame,
    items: DataFrame,
    least_support: float = LEAST_SUPPORT,
    least_confidence: float = LEAST_CONFIDENCE,
) -> DataFrame:
    """(items, verdict, confidence, support) mined from rows (tokens, verdict), written once."""
    held = with_items(labelled.select("tokens").distinct(), items)
    rows = labelled.join(held, "tokens", "left")
    none = F.array().cast("array<string>")
    baskets = rows.select(F.array_append(F.coalesce("items", none), F.concat(F.lit(VERDICT), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least_support, minConfidence=least_confidence).fit(baskets)
    found = model.associationRules.filter(
        F.element_at("consequent", 1).startswith(VERDICT) & ~F.exists("antecedent", lambda t: t.startswith(VERDICT))
    )
    rules = found.select(
        F.array_sort("antecedent").alias("items"),
        F.substring(F.element_at("consequent", 1), len(VERDICT) + 1, 1000).alias("verdict"),
        "confidence",
        "support",
    )
    rules = settle(rules, "rules")
    fewer = F.transform("items", lambda t: F.array_remove(F.col("items"), t))
    parents = rules.filter(F.size("items") > 1).select("*", F.explode(fewer).alias("fewer"))
    known = rules.select(F.col("items").alias("fewer"), "verdict", F.col("confidence").alias("before"))
    beaten = parents.join(known, ["fewer", "verdict"]).filter("before >= confidence").select("items", "verdict")
    return settle(rules.join(beaten.distinct(), ["items", "verdict"], "left_anti"), "rules")


def judged_tokens(token_sets: DataFrame, items: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, method_verdict) of the distinct token sets for which a mined rule holds."""
    held = settle(with_items(token_sets, items), "held")
    uses = held.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("uses"))
    filed = rules.select(F.col("items").alias("rule_items"), "verdict", "confidence", "support", F.explode("items").alias("item"))
    rarest = F.min_by("item", F.struct("uses", "item"))
    index = (
        filed.join(uses, "item")
        .groupBy("rule_items", "verdict", "confidence", "support")
        .agg(rarest.alias("item"), F.count("*").alias("met"))
        # An item no url has keeps the rule from fitting any.
        .filter(F.col("met") == F.size("rule_items"))
    )
    asked = held.select("tokens", "items", F.explode("items").alias("item"))
    fits = asked.join(index.drop("met"), "item").filter(F.size(F.array_except("rule_items", "items")) == 0)
    surest = F.max_by("verdict", F.struct("confidence", "support", "rule_items", "verdict"))
    return fits.groupBy("tokens").agg(surest.alias("method_verdict"))


def judge(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    least_support: float = LEAST_SUPPORT,
    least_confidence: float = LEAST_CONFIDENCE,
) -> DataFrame:
    """``pages`` with the struct ``judged``: host, path, rule, verdict and tokens."""
    parsed = pages.withColumn("__host", host_of(url)).withColumn("__path", path_of(url))
    parsed = parsed.withColumn("__rule", fitting_rule("__host", "__path", rules))
    parsed = parsed.withColumn("__tokens", url_tokens(url, "__host", "__path"))
    decided = parsed.filter("__rule IS NOT NULL")
    labelled = decided.select(F.col("__tokens").alias("tokens"), F.col("__rule.verdict").alias("verdict"))
    items = items_of(labelled, least_support)
    mined = mined_rules(labelled, items, least_support, least_confidence)
    open_sets = parsed.filter("__rule IS NULL").select(F.col("__tokens").alias("tokens")).distinct()
    found = judged_tokens(open_sets, items, mined).select(F.col("tokens").alias("__tokens"), "method_verdict")
    joined = parsed.join(found.withColumnRenamed("method_verdict", "__found"), "__tokens", "left")
    verdict = F.coalesce("__rule.verdict", "__found", F.lit(DEFAULT))
    return joined.select(
        *[joined[c] for c in pages.columns],
        F.struct(
            F.col("__host").alias("host"),
            F.col("__path").alias("path"),
            F.col("__rule.rule").alias("rule"),
            verdict.alias("verdict"),
            F.col("__tokens").alias("tokens"),
        ).alias("judged"),
    )


@query()
def op3_url_rules(spark, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")
