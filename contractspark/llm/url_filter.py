"""URL filter by host reputation: empirical-Bayes shrinkage host -> registered domain -> suffix -> all.

Labelled pages give each host (good, labelled) counts. A level's means scatter about their parents' more than binomial
noise explains; the method of moments turns that excess into the strength of a beta prior, whose mean is the posterior mean
of the parent. A host's posterior is then Beta(strength * mean(domain) + good, strength * (1 - mean(domain)) + bad): a host
without labels has its domain's view, a host with thousands its own. A page is blocked if the upper bound of its host's
posterior (mean + ``z`` standard deviations) is below ``least_good``, by default ``share`` of the mean of all labelled pages,
i.e. only where the evidence is firm that a host is clearly worse than the rest.

Rules (host with path, block or allow) come first: a rule fits its host and all subdomains if the path starts with the
rule's; the longest fitting rule wins (the first in text order among equally long ones).

Counts per host are partial sums, so a host with a third of the pages costs a row per task. They are stored once; all that
follows works on hosts, and pages meet their host's row in a join that adaptive execution can split. The strengths are three
single-row results; no table is collected or broadcast.

Without a public list at hand the suffix is the last label of the host, or two of ``suffixes`` (a parameter), and the
registered domain one label more; numeric addresses are their own domain. Defined cases: null url or one without ``://``
has an empty host and path, and the empty host is a host like others; a port stays in the host but not in its domain;
null page ids have no labels; a page labelled twice is good if any of its labels is; without labels every mean is 1/2 and
nothing is blocked; repeated rows are judged each; an empty table gives no rows. The result has columns of its own only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractspark.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (its text) that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):  # later ones win
        own, _, start = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit("/" + start))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def with_domains(hosts: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    name = F.regexp_replace("host", r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    two = F.substring_index(name, ".", -2).isin(*suffixes) if suffixes else F.lit(False)
    numeric = name.rlike(r"^[0-9.]+$")
    suffix = F.when(numeric, F.lit("")).when(two, F.substring_index(name, ".", -2)).otherwise(F.element_at(labels, -1))
    domain = F.when(numeric, name).when(two, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return hosts.withColumns({"suffix": suffix, "domain": domain})


def strength(groups: DataFrame) -> float:
    """Prior strength of groups (n, good, mean of the parent): 1 / overdispersion - 1, by moments; one row comes back."""
    n, p = F.col("n"), F.col("mean")
    noise = p * (1 - p)
    s, expect, weight = groups.where("n > 0").agg(
        F.sum(n * F.pow(F.col("good") / n - p, 2)), F.sum(noise), F.sum(noise * (n - 1))).first()
    rho = (s - expect) / weight if weight else 1 / 3
    rho = min(max(rho, 1e-4), 0.9)
    return 1 / rho - 1


def shrunk(groups: DataFrame, k: float) -> Column:
    return (k * F.col("mean") + F.col("good")) / (k + F.col("n"))


def host_posteriors(outcomes: DataFrame, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(host, n, good, alpha, beta, overall) from rows (host, good: 0, 1 or null for no label); ``overall`` is the mean of all."""
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    hosts = stored(with_domains(hosts, suffixes), "hosts")
    n, good = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    by_suffix = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("mean", F.lit((good + 1) / (n + 2)))
    by_suffix = by_suffix.select("suffix", shrunk(by_suffix, strength(by_suffix)).alias("mean"))
    by_domain = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).join(by_suffix, "suffix")
    by_domain = by_domain.select("domain", "suffix", shrunk(by_domain, strength(by_domain)).alias("mean"))
    each = hosts.join(by_domain, ["domain", "suffix"])
    k = strength(each)
    return each.select("host", "n", "good", (k * F.col("mean") + F.col("good")).alias("alpha"),
                       (k * (1 - F.col("mean")) + F.col("n") - F.col("good")).alias("beta"), F.lit((good + 1) / (n + 2)).alias("overall"))


def judge(pages: DataFrame, labels: DataFrame, rules: dict[str, str], *, id_col: str = "page_id", url_col: str = "url",
          label_id: str = "doc_id", label: str = "quality", least_good: float | None = None, share: float = 0.8,
          z: float = 1.645, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """page id, host, path, rule, verdict, labelled, posterior_mean and posterior_upper of every page."""
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    seen = labels.groupBy(F.col(f"`{label_id}`").alias("_id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("good"))
    posteriors = host_posteriors(rows.join(seen, "_id", "left").select("host", "good"), suffixes)
    a, b = F.col("alpha"), F.col("beta")
    mean = a / (a + b)
    upper = F.least(F.lit(1.0), mean + z * F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1))))
    limit = F.lit(least_good) if least_good is not None else share * F.col("overall")
    told = posteriors.select("host", limit.alias("limit"), F.col("n").alias("labelled"), mean.alias("posterior_mean"), upper.alias("posterior_upper"))
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    verdicts = reduce(lambda out, r: F.when(F.col("rule") == r[0], F.lit(r[1])).otherwise(out), rules.items(),
                      F.when(F.col("posterior_upper") < F.col("limit"), F.lit("block")).otherwise(F.lit("allow")))
    return (rows.join(told, "host").withColumn("rule", rule)
            .select(F.col("_id").alias(id_col), "host", "path", "rule", verdicts.alias("verdict"), "labelled", "posterior_mean", "posterior_upper"))
