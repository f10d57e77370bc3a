"""Empirical-Bayes reputation of hosts. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.shared import cut, lower_ascii, salted_join

#: verdict, host, path of each rule.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


#: Labels below which the registers of countries (last labels of two letters) give out domains. Fixed values.
SECOND = ("ac", "asn", "co", "com", "edu", "go", "gob", "gouv", "gov", "gv", "id", "info", "ltd", "me", "mil", "ne", "net", "nic", "nom", "or", "org", "plc", "sch")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a url without `://`."""
    found = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(u, found, 1)), F.regexp_extract(u, found, 2)


def longest_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. The rules are a parameter, so their number is fixed."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in rules]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")


def site(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":[0-9]*\z", "")


def levels(name: Column, second: tuple[str, ...] = SECOND, listed: Column | None = None) -> tuple[Column, Column]:
    """Registered domain and suffix of a site. An address has neither: it is its own domain, under the empty suffix.

    The suffix is `listed` where that isn't null; else the last two labels, if these are one of `second` and two letters;
    else the last label. The domain is one label more, or the whole site if there is no more.
    """
    address = name.rlike(r"^\[.*\]\z|^[0-9]{1,3}(\.[0-9]{1,3}){3}\z")
    of_country = name.rlike(rf"(?:^|\.)(?:{'|'.join(second)})\.[a-z]{{2}}\z") if second else F.lit(False)
    suffix = F.when(of_country, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))
    suffix = suffix if listed is None else F.coalesce(listed, suffix)
    labels = F.split(name, r"\.")
    more = F.size(F.split(suffix, r"\.")) + 1
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - more + 1, F.lit(1)), more), ".")
    return F.when(address, name).otherwise(domain), F.when(address, "").otherwise(suffix)


def with_levels(counted: DataFrame, second: tuple[str, ...], suffixes: DataFrame | None) -> DataFrame:
    """host, domain, suffix, n, bad. Of `suffixes` (suffix) the longest that ends a host is its suffix, whatever `second` says."""
    if suffixes is None:
        domain, suffix = levels(F.col("host"), second)
        return counted.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    known = suffixes.select(F.lower("suffix").alias("_end")).where("_end <> ''").distinct()
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    # a row for each host and end of it; hosts are distinct here, and a join by equality leaves any list's size open
    found = counted.select("host", F.explode(ends).alias("_end")).join(known, "_end").groupBy("host").agg(F.max_by("_end", F.length("_end")).alias("_listed"))
    rows = counted.join(found, "host", "left")
    domain, suffix = levels(F.col("host"), second, F.col("_listed"))
    return rows.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")


def _rates(counts: DataFrame, key: str, parent: DataFrame | None, up: str | None) -> DataFrame:
    """key (with the keys above it), n, bad, and a, b of the beta posterior.

    The prior's mean is the parent's posterior mean (at the top the overall rate with one page added to either side).
    Its strength is one number for the level, by the method of moments: the spread of the children's rates around
    their parents' beyond what drawing n pages explains; held between 1 and 1000. As the parent's own rate isn't certain,
    variances add: a parent with a + b = p makes a strength s one of p s / (p + s + 1).
    """
    if parent is None:
        mean = counts.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("m"))
        rows = counts.crossJoin(F.broadcast(mean))
    else:
        above = parent.select(up, (F.col("a") / (F.col("a") + F.col("b"))).alias("m"), (F.col("a") + F.col("b")).alias("p"))
        rows = counts.join(above, up)
    spread = rows.where("n > 1").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), F.lit(2))).alias("ss"),
        F.sum(F.col("m") * (1 - F.col("m"))).alias("noise"),
        F.sum((F.col("n") - 1) * F.col("m") * (1 - F.col("m"))).alias("room"),
    )
    # correlation within a key: (excess spread) / (most excess spread); strength = 1 / correlation - 1
    rho = (F.col("ss") - F.col("noise")) / F.col("room")
    strength = F.when(F.col("room") > 0, F.greatest(F.lit(1.0), F.least(F.lit(1000.0), 1 / F.greatest(rho, F.lit(1e-6)) - 1))).otherwise(F.lit(1.0))
    rows = rows.crossJoin(F.broadcast(spread.select(F.round(strength, 6).alias("s"))))
    if parent is not None:
        rows = rows.withColumn("s", F.col("p") * F.col("s") / (F.col("p") + F.col("s") + 1))
    return rows.select(*counts.columns, (F.col("bad") + F.col("m") * F.col("s")).alias("a"), (F.col("n") - F.col("bad") + (1 - F.col("m")) * F.col("s")).alias("b"))


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, worst: float = 0.2, z: float = 1.645, keep: tuple[str, ...] = (), second: tuple[str, ...] = SECOND, suffixes: DataFrame | None = None) -> DataFrame:
    """A verdict for every page: the longest fitting rule's, else by its host's reputation.

    A labelled page (labels.doc_id = page_id) is bad if its quality is 0 or it is toxic. The rate of bad pages of a
    suffix, a registered domain and a host is shrunk towards the level above. User and port are no part of a host here,
    and addresses have no domain above them. A suffix is a last label, or a country's and one of `second` before it;
    a table of suffixes, such as the public list read from a file, goes before that rule.
    A host is blocked if the lower bound of its posterior (mean - z standard deviations) is above `worst`, so only on
    evidence. Of a suffix each domain's rate counts once. Hosts without labelled pages have their domain's, then their
    suffix's posterior, widened by one prior. Null or unparsable urls have empty host and path, and are allowed without labels against them. Repeated pages count
    each; repeated labels of a page count each; labels without quality and toxic count as good; empty tables are fine.
    Columns: page_id, host, path, rule, verdict, and those of `keep`.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), *keep).withColumn("_site", site(F.col("host")))
    marks = labels.select(F.col("doc_id").alias("_page"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("_bad")).groupBy("_page").agg(F.count("*").alias("_n"), F.sum("_bad").alias("_bad"))
    # counted by host before any level is built: what follows has a row for each host at most, and each level is stored
    counted = rows.join(marks, F.col("page_id") == F.col("_page"), "left").groupBy(F.col("_site").alias("host")).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad"))
    hosts = cut(with_levels(counted, second, suffixes))
    domains = cut(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    # a domain is one observation of its suffix, however many pages it has: else one bad domain would condemn all others there
    seen = F.col("n") > 0
    tops = cut(domains.groupBy("suffix").agg(F.sum(F.when(seen, 1.0).otherwise(0.0)).alias("n"), F.sum(F.when(seen, F.col("bad") / F.col("n")).otherwise(0.0)).alias("bad")))
    top = cut(_rates(tops, "suffix", None, None))
    middle = cut(_rates(domains, "domain", top, "suffix"))
    low = _rates(hosts, "host", middle, "domain")
    total = F.col("a") + F.col("b")
    bound = F.col("a") / total - F.lit(z) * F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))
    known = cut(low.select(F.col("host").alias("_site"), F.when(bound > worst, F.lit("block")).otherwise(F.lit("allow")).alias("_verdict")))
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    judged = salted_join(rows, known, "_site", "left").withColumn("_rule", rule)
    return judged.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), F.col("_verdict"), F.lit("allow")).alias("verdict"), *keep)
