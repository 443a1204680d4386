"""URL filtering by rules and by an empirical-Bayes reputation of hosts, in SQL functions only.

Labelled pages are counted per host (partial counts before the shuffle, so one huge host costs one
row a task). Hosts borrow from their registered domain, domains from their suffix, suffixes from the
whole table (user info and ports left out; an address is a domain and a suffix of its own): at each level a child's rate of bad pages has a beta prior with the parent's mean, and
the prior's strength is estimated from how much the children differ (moments of the beta-binomial).
A host is blocked if even the lower bound of its posterior rate of bad pages is too high.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Verdict by host and path.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

# Suffixes of two labels under which names are registered. Others have one label.
TWO_LABELS = (
    "ac.jp ac.nz ac.uk ac.za asn.au co.id co.il co.in co.jp co.ke co.kr co.nz co.th co.uk co.za com.ar com.au com.br com.cn com.co com.eg "
    "com.es com.hk com.mx com.my com.ng com.pe com.ph com.pk com.pl com.sa com.sg com.tr com.tw com.ua com.uy com.ve com.vn edu.au edu.br "
    "edu.cn edu.in edu.mx edu.tr go.jp go.kr gob.ar gob.mx gov.au gov.br gov.cn gov.in gov.uk gov.za ltd.uk me.uk ne.jp net.au net.br net.cn "
    "net.in net.nz net.uk nhs.uk or.jp or.kr org.ar org.au org.br org.cn org.in org.mx org.nz org.pl org.tr org.tw org.uk org.za plc.uk police.uk "
    "sch.uk"
).split()
# Addresses, which have no domain above them.
ADDRESS = "^([0-9]+[.][0-9]+[.][0-9]+[.][0-9]+|\\[.*)$"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Prior strengths (pages that the parent's rate counts for) stay within these.
WEAKEST, STRONGEST = 1.0, 1000.0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    start = F.locate("://", url)
    rest = F.coalesce(F.when(start > 0, url.substr(start + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, as written; null if none does. One comparison a rule and row."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def name_parts(host: Column) -> tuple[Column, Column]:
    """Suffix and registered domain of a host."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    two = F.regexp_extract(bare, "([^.]*[.])?[^.]*$", 0)
    three = F.regexp_extract(bare, "([^.]*[.])?[^.]*[.][^.]*$", 0)
    address, long = bare.rlike(ADDRESS), two.isin(TWO_LABELS)
    suffix = F.when(address, bare).when(long, two).otherwise(F.regexp_extract(bare, "[^.]*$", 0))
    return suffix, F.when(address, bare).when(long, three).otherwise(two)


def reputation(hosts: DataFrame) -> DataFrame:
    """``host, rate, bound`` from ``host, n, bad`` (labelled pages and bad ones, one row a host).

    ``rate`` is the posterior mean of the rate of bad pages, ``bound`` lies two standard deviations
    below it. A host without labelled pages gets its parents' rate and a wide bound.
    """
    suffix, domain = name_parts(F.col("host"))
    rows = hosts.select("host", "n", "bad", suffix.alias("suffix"), domain.alias("domain"))
    domains = rows.groupBy("domain", "suffix").agg(*_sums())
    suffixes = domains.groupBy("suffix").agg(*_sums())
    # One row per suffix: the only window over a whole table.
    everything = W.partitionBy()
    top = (F.sum("bad").over(everything) + 0.5) / (F.sum("n").over(everything) + 1.0)
    strength = _strength(F.sum("n").over(everything), F.sum("bad").over(everything),
                         *(f.over(everything) for f in _spread()))
    suffix_rate = suffixes.select("suffix", _posterior(top, strength).alias("suffix_rate"))
    domain_rate = _level(domains, "suffix", suffix_rate, "suffix_rate").select("domain", F.col("_rate").alias("domain_rate"))
    level = _level(rows, "domain", domain_rate, "domain_rate")
    a = F.col("bad") + F.col("_strength") * F.col("domain_rate")
    total = F.col("n") + F.col("_strength")
    sd = F.sqrt(F.col("_rate") * (1 - F.col("_rate")) / (total + 1))
    return level.select("host", F.col("_rate").alias("rate"), (a / total - 2 * sd).alias("bound"))


def _sums() -> list[Column]:
    return [F.sum("n").alias("n"), F.sum("bad").alias("bad")]


def _spread() -> list[Column]:
    """Sums over the children with labelled pages: count, n squared, bad squared / n."""
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    return [F.sum(F.when(n > 0, 1.0)), F.sum(n * n), F.sum(F.try_divide(bad * bad, n))]


def _strength(n: Column, bad: Column, children: Column, squares: Column, shares: Column) -> Column:
    """Pages that the parent's rate counts for, by the moments of the beta-binomial."""
    p = F.try_divide(bad, n)
    free = p * (1 - p)
    between = shares - n * p * p
    share = F.try_divide(between - free * (children - 1), free * (n - F.try_divide(squares, n) - (children - 1)))
    strength = F.when(share > 0, F.try_divide(F.lit(1.0), share) - 1).otherwise(F.lit(STRONGEST))
    return F.least(F.greatest(F.coalesce(strength, F.lit(STRONGEST)), F.lit(WEAKEST)), F.lit(STRONGEST))


def _posterior(parent: Column, strength: Column) -> Column:
    return (F.col("bad") + strength * parent) / (F.col("n") + strength)


def _level(children: DataFrame, key: str, parents: DataFrame, rate: str) -> DataFrame:
    """Children with their parent's rate, the strength of that prior and their own posterior mean."""
    spread = children.groupBy(key).agg(
        F.sum("n").alias("_n"), F.sum("bad").alias("_bad"),
        *[f.alias(f"_s{i}") for i, f in enumerate(_spread())])
    prior = spread.join(parents, key).select(
        key, rate, _strength(F.col("_n"), F.col("_bad"), F.col("_s0"), F.col("_s1"), F.col("_s2")).alias("_strength"))
    joined = children.join(prior, key)
    return joined.withColumn("_rate", _posterior(F.col(rate), F.col("_strength")))


def judge(pages: DataFrame, labels: DataFrame, rules: dict[str, str] = RULES, max_bad: float = 0.2,
          id: str = "page_id", url: str = "url", label_id: str = "doc_id", good: str = "quality") -> DataFrame:
    """``page_id, host, path, rule, verdict, rate`` of every page.

    A page is bad where ``labels`` give its id a ``good`` of 0; rows with a null there count for
    nothing, several labels of an id count each. Without a rule a page is blocked if its host's
    bound is above ``max_bad``. A null url has empty host and path, which form a host of their own.
    Repeated pages are rows of their own. Other columns are ignored; empty tables give no rows.
    """
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(id).alias("page_id"), host.alias("host"), path.alias("path"))
    outcome = F.col(good)
    counts = (
        labels.select(F.col(label_id).alias("page_id"), outcome.alias("_good")).where("page_id IS NOT NULL AND _good IS NOT NULL")
        .groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("_good") == 0, 1).otherwise(0)).alias("bad"))
    )
    labelled = rows.join(counts, "page_id", "inner").groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    seen = rows.groupBy("host").agg(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    hosts = seen.unionByName(labelled).groupBy("host").agg(*_sums())
    known = rows.join(reputation(hosts), "host", "left").withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    by_host = F.when(F.col("bound") > max_bad, "block").otherwise("allow")
    return known.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_host).alias("verdict"),
                        F.round("rate", 6).alias("rate"))
