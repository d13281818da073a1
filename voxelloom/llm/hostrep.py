"""URL filtering by rules and by empirical-Bayes host reputation; DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Standard deviations of the posterior below its mean, and the rate of bad outcomes above which that bound blocks a host.
DEVIATIONS, WORST = 1.645, 0.3
#: Bounds of a prior's strength, in pseudo-outcomes.
WEAKEST, STRONGEST = 2.0, 1000.0
# Second-level labels that are taken for suffixes under a country's two letters, as in co.uk.
SECOND_LEVEL = "ac co com edu go gob gov gr ltd mil ne net nhs nom or org plc sch".split()


@dataclass(frozen=True)
class Rule:
    """`name` is a host and a path, as in `example.com/de/`."""

    name: str
    verdict: str

    @property
    def host(self) -> str:
        return self.name.partition("/")[0].translate(str.maketrans(UPPER, LOWER))

    @property
    def path(self) -> str:
        return "/" + self.name.partition("/")[2] if "/" in self.name else ""


def url_host(url: Column) -> Column:
    """What stands between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def site(host: Column) -> Column:
    """The host without user name and port."""
    return F.regexp_replace(F.regexp_replace(host, r"\A.*@", ""), r":\d*\z", "")


def public_suffix(name: Column, second_level: list[str]) -> Column:
    """The last label, or the last two where the last has two letters and the one before is in `second_level`; a numeric or bracketed address has none and is its own suffix."""
    labels = F.split(name, r"\.")
    last, two = F.element_at(labels, -1), F.array_join(F.slice(labels, -2, 2), ".")
    known = (F.size(labels) > 1) & (F.length(last) == 2) & F.get(labels, F.size(labels) - 2).isin(second_level)
    return F.when(_address(name), name).when(known, two).otherwise(last)


def suffixes_by_rules(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """(site, suffix) of each distinct site by a table of suffix rules (rule), of any number, in the form of the public suffix list.

    A rule `co.uk` is the suffix of all names that end so; `*.ck` of any one label before `ck`; `!www.ck` excepts a name from such a rule, its suffix is what follows its first
    label. An exception goes before all other rules, else the rule of most labels holds; without one the suffix is the last label. An address is its own suffix. Names meet rules by an
    equi-join on their ends, so neither side need be small. Null and repeated rules count once or not at all.
    """
    rows = sites.select("site").distinct().withColumn("labels", F.split("site", r"\."))
    ends = rows.where(~_address(F.col("site"))).select("site", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("k"))
    after = lambda k: F.array_join(F.slice("labels", k, F.size("labels")), ".")
    own, parent = after(F.col("k")), F.when(F.col("k") < F.size("labels"), after(F.col("k") + 1)).otherwise("")
    depth = F.size("labels") - F.col("k") + 1
    keys = F.array(*[F.struct(name.alias("rule"), F.lit(excepts).alias("excepts"), depth.alias("depth"), suffix.alias("suffix")) for name, excepts, suffix in ((own, 0, own), (F.concat(F.lit("*."), parent), 0, own), (F.concat(F.lit("!"), own), 1, parent))])
    met = ends.select("site", F.explode(keys).alias("r")).select("site", "r.*").join(rules.select(F.translate("rule", UPPER, LOWER).alias("rule")).distinct(), "rule")
    best = met.groupBy("site").agg(F.max(F.struct("excepts", "depth", "suffix")).alias("best")).select("site", F.col("best.suffix").alias("known"))
    return rows.join(best, "site", "left").select("site", F.coalesce("known", F.when(_address(F.col("site")), F.col("site")).otherwise(F.element_at("labels", -1))).alias("suffix"))


def registered_domain(name: Column, suffix: Column) -> Column:
    """The suffix and one label more; the name itself if it has no more."""
    depth = F.size(F.split(suffix, r"\.")) + 1
    labels = F.split(name, r"\.")
    return F.when(_address(name) | (F.size(labels) <= depth), name).otherwise(F.array_join(F.slice(labels, -depth, depth), "."))


def _address(name: Column) -> Column:
    return name.rlike(r"\A(\d+\.){3}\d+\z|\A\[")


def _rules(rules: list[Rule] | DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, fits) of the hosts that rules name, or a parent of which they name; fits are the rules' (size, rule, path, verdict).

    `rules` is a list, or rows (name, verdict) of any number: hosts and their parents meet rules by an equal name.
    """
    if not isinstance(rules, DataFrame):
        named = F.array(*[F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")) for r in rules]) if rules else F.lit(None).cast("array<struct<name string, verdict string>>")
        rules = hosts.sparkSession.range(1).select(F.explode(named).alias("r")).select("r.name", "r.verdict")
    cut = F.instr("name", "/")
    rules = rules.select(
        F.translate(F.when(cut > 0, F.substring_index("name", "/", 1)).otherwise(F.col("name")), UPPER, LOWER).alias("parent"),
        F.struct(F.length("name").alias("size"), F.col("name").alias("rule"), F.when(cut > 0, F.expr("substring(name, instr(name, '/'))")).otherwise("").alias("path"), "verdict").alias("fit"),
    )
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    return hosts.select("host", F.explode(parents).alias("parent")).join(rules, "parent").groupBy("host").agg(F.collect_list("fit").alias("fits"))


def _strength(children: DataFrame) -> float:
    """Prior strength of one level by the method of moments over its groups (n, bad), as for a beta-binomial."""
    rate = F.sum("bad") / F.sum("n")
    r = children.where("n > 0").agg(F.count("*").alias("groups"), F.sum("n").alias("n"), rate.alias("rate"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("squares"), F.sum(F.col("n") * F.col("n")).alias("n2")).first()
    if not r["n"] or r["groups"] < 2 or not 0 < r["rate"] < 1:
        return STRONGEST
    noise = r["rate"] * (1 - r["rate"])
    room = r["n"] - r["n2"] / r["n"]
    between = (r["squares"] - r["n"] * r["rate"] ** 2 - (r["groups"] - 1) * noise) / room if room > 0 else 0.0
    share = between / noise
    return min(max(1 / share - 1, WEAKEST), STRONGEST) if share > 0 else STRONGEST


def reputation(outcomes: DataFrame, second_level: list[str] = SECOND_LEVEL, suffix_rules: DataFrame | None = None) -> DataFrame:
    """(host, n, bad, bad_rate, bound) of every host in (host, n, bad) rows, one a host.

    A host's rate of bad outcomes is drawn to its registered domain's, a domain's to its public suffix's (`co.uk` or `com`, see `public_suffix`, or `suffixes_by_rules` if there is a table of rules;
    user names and ports don't count), a suffix's to the whole table's, each through
    a beta prior whose mean is the parent's posterior mean and whose strength fits the spread
    of the level's groups. bound lies DEVIATIONS posterior standard deviations below the
    posterior mean. Hosts without outcomes get their parents' rates.
    """
    named = outcomes.withColumn("site", site(F.col("host")))
    suffixed = named.withColumn("suffix", public_suffix(F.col("site"), second_level)) if suffix_rules is None else named.join(suffixes_by_rules(named, suffix_rules), "site")
    hosts = suffixed.drop("site").withColumn("domain", registered_domain(site(F.col("host")), F.col("suffix")))
    hosts = materialize(hosts, "hosts")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    total = suffixes.agg(*sums).first()
    s_host, s_domain, s_suffix = (_strength(x) for x in (hosts, domains, suffixes))
    mean = (total["bad"] or 0) / total["n"] if total["n"] else 0.0  # nothing known blocks nothing

    def posterior(prior: Column, strength: float) -> Column:
        return (prior * strength + F.col("bad")) / (strength + F.col("n"))

    suffixes = suffixes.select("suffix", posterior(F.lit(mean), s_suffix).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select("suffix", "domain", posterior(F.col("suffix_rate"), s_domain).alias("domain_rate"))
    rate = posterior(F.col("domain_rate"), s_host)
    spread = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.col("n") + s_host + 1))
    return hosts.join(domains, ["suffix", "domain"]).select("host", "n", "bad", rate.alias("bad_rate")).withColumn("bound", F.col("bad_rate") - DEVIATIONS * spread)


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule] | DataFrame, id_col: str = "page_id", url_col: str = "url", worst: float = WORST, suffix_rules: DataFrame | None = None) -> DataFrame:
    """(id_col, host, path, rule, verdict, bad_rate, bound) of every page row.

    `labels` has (doc_id, quality, toxic) for some pages. That its doc_id is the id of a page is an assumption of the caller: the test tables have no other
    outcomes of pages. An outcome is bad if toxic is 1 or quality 0, and
    several rows of one page count as one, bad if any is. The longest fitting
    rule gives the verdict, else the host: block if the lower bound of its rate of bad
    outcomes exceeds `worst`. Null urls and urls without `://` have host and path ''; they are judged as one
    host. A port or user name is a part of the host for rules and output, but not for domain and suffix. Null ids have no outcome. Repeated page rows each count and each get a row. Hosts are
    pre-aggregated; a host with a third of the pages may be split among tasks in the final join, or the host
    table is broadcast if its measured size allows.
    """
    rows = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    outcome = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)).alias("bad"))
    seen = materialize(rows.select("id", "host").join(outcome, "id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "host-outcomes")
    known = reputation(seen, suffix_rules=suffix_rules).select("host", "bad_rate", "bound").join(_rules(rules, seen.select("host")), "host", "left")
    fit = F.array_max(F.filter(F.coalesce("fits", F.array().cast("array<struct<size int, rule string, path string, verdict string>>")), lambda r: F.col("path").startswith(r["path"])))
    return (
        rows.join(known, "host")
        .withColumn("fit", fit)
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            F.col("fit.rule").alias("rule"),
            F.coalesce("fit.verdict", F.when(F.col("bound") > worst, "block").otherwise("allow")).alias("verdict"),
            "bad_rate",
            "bound",
        )
    )
