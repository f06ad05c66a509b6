"""Which URLs may be collected: scheme, host allowlist, resolved address."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.functions import addresses, urls
from webcorpus.functions.text import once, strip
from webcorpus.operators.joins import lookup
from webcorpus.session import written
from webcorpus.settings import ALLOWED_HOSTS, WEB_SCHEMES


def filter_scheme(df: DataFrame, url: str = "url") -> DataFrame:
    return df.filter(urls.scheme_of(F.col(url)).isin(WEB_SCHEMES))


def filter_domain_suffix(df: DataFrame, domain: str, url: str = "url") -> DataFrame:
    """Rows on `domain` itself or any host below it."""
    return once(df, _host=urls.host_of(F.col(url))) \
        .filter(urls.in_domain(F.col("_host"), domain)).drop("_host")


def host_semi_join(df: DataFrame, hosts: DataFrame, host: str = "host") -> DataFrame:
    """Rows whose host is in the table `hosts`, which may grow with the crawl."""
    return lookup(df, hosts.select(host).distinct(), host, "left_semi").select(df.columns)


def filter_hosts(df: DataFrame, allowed: Sequence[str] | DataFrame = ALLOWED_HOSTS,
                 url: str = "url") -> DataFrame:
    """Rows whose host is allowed exactly; a list is a literal test, a table is a semi-join."""
    with_host = once(df, _host=urls.host_of(F.col(url)))
    if isinstance(allowed, DataFrame):
        hosts = allowed.select(F.col("host").alias("_host"))
        return host_semi_join(with_host, hosts, "_host").drop("_host")
    return with_host.filter(F.col("_host").isin(list(allowed))).drop("_host")


def first_addresses(lookups: DataFrame) -> DataFrame:
    """(host, ip): one first address per host of a stored (host, ip, ord) table.

    A host that was looked up several times counts by a blocked address if it ever had one, else by
    the smallest as text, so that a repeated lookup can neither multiply rows nor unblock a host.
    """
    first = lookups.filter((F.col("ord") == 0) & F.col("ip").isNotNull())
    worst = F.min(F.struct(~addresses.is_blocked(F.col("ip")), F.col("ip").alias("ip")))
    return first.groupBy("host").agg(worst["ip"].alias("ip"))


def resolve_hosts(df: DataFrame, lookups: DataFrame) -> DataFrame:
    """Add `ip`: the host's first address; an address literal is its own; NULL is unresolved."""
    literal = addresses.is_ipv4(F.col("host")) | F.col("host").contains(":")
    return (lookup(df, first_addresses(lookups), "host")
            .withColumn("ip", F.when(literal, F.col("host")).otherwise(F.col("ip"))))


def prefixes(ranges: DataFrame) -> DataFrame:
    """(prefix, blocked) of a table (cidr, blocked); the binary digits that all addresses of a range share.

    A range that is listed twice is blocked if it ever is. What is no CIDR range is an error.
    """
    start, length = F.substring_index("cidr", "/", 1), F.substring_index("cidr", "/", -1)
    bits = addresses.ip_bits(start)
    legal = bits.isNotNull() & length.rlike("^[0-9]{1,3}$") & (length.cast("int") < F.length(bits)) & F.col("cidr").contains("/")
    checked = F.when(legal, F.substr(bits, F.lit(1), length.cast("int") + 1)).otherwise(
        F.raise_error(F.concat(F.lit("no CIDR range: "), F.coalesce("cidr", F.lit("null")))))
    return ranges.groupBy(checked.alias("prefix")).agg(F.bool_or("blocked").alias("blocked"))


def judge_addresses(df: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Add `blocked`: what the most specific range (cidr, blocked) says that holds the address.

    An address in no range, and what is no address, is blocked. IPv4 and IPv6 may be mixed. Addresses
    are looked up by their prefixes, of the lengths that occur (161 at most): equal keys at any size
    of either side, no comparison of all with all. Each address is looked up once.
    """
    table = written(prefixes(ranges), "prefixes")
    lengths = [r[0] for r in table.select(F.struct(F.substring("prefix", 1, 1).alias("kind"), F.length("prefix").alias(
        "n"))).distinct().collect()]
    known = df.select(F.col(ip).alias("_ip")).filter(F.col("_ip").isNotNull()).distinct()
    digits = once(known, _bits=addresses.ip_bits(F.col("_ip"))).filter(F.col("_bits").isNotNull())
    keys = F.array(*[F.when(F.col("_bits").startswith(kind), F.substring("_bits", 1, n)) for kind, n in lengths]) \
        if lengths else F.array().cast("array<string>")
    asked = digits.select("_ip", F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("prefix"))
    judged = lookup(asked, table, "prefix", "inner").groupBy("_ip").agg(
        F.max(F.struct(F.length("prefix").alias("n"), "blocked"))["blocked"].alias("_blocked"))
    joined = lookup(df.withColumn("_ip", F.col(ip)), written(judged, "judged"), "_ip")
    return joined.select(*df.columns, F.coalesce("_blocked", F.lit(True)).alias("blocked"))


def filter_blocked_ips(df: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Drop unresolved rows and addresses inside blocked ranges: the fixed ones, or a table (cidr, blocked)."""
    if ranges is not None:
        return judge_addresses(df, ranges).filter(~F.col("blocked")).drop("blocked")
    return df.filter(F.col("ip").isNotNull() & ~addresses.is_blocked(F.col("ip")))


def _reason(*tests: tuple[str, Column]) -> Column:
    return F.coalesce(*[F.when(test, F.lit(name)) for name, test in tests])


def host_table(allowed: DataFrame, lookups: DataFrame) -> DataFrame:
    """(host, ip, allowed): the allowlist and the first addresses, a row per host. May be stored for a run."""
    flags = first_addresses(lookups).withColumn("ok", F.lit(False)).unionByName(
        allowed.select("host", F.lit(None).cast("string").alias("ip"), F.lit(True).alias("ok")))
    return flags.groupBy("host").agg(F.max("ip").alias("ip"), F.bool_or("ok").alias("allowed"))


def admission(df: DataFrame, allowed: DataFrame, lookups: DataFrame,
              url: str = "url") -> DataFrame:
    """Add `reject_reason`: scheme, host, unresolved or ip, whichever fails first; NULL passes.

    Allowlist and addresses meet in one small table first, so the URLs are joined only once.
    """
    return admission_by(df, host_table(allowed, lookups), url)


def admission_by(df: DataFrame, hosts: DataFrame, url: str = "url") -> DataFrame:
    """The same with a host_table()."""
    per_host = hosts.select(F.col("host").alias("_host"), F.col("ip").alias("_ip"), F.col("allowed").alias("_allowed"))
    parts = once(df, _scheme=urls.scheme_of(F.col(url)), _host=urls.host_of(F.col(url)))
    joined = lookup(parts, per_host, "_host")
    literal = addresses.is_ipv4(F.col("_host")) | F.col("_host").contains(":")
    ip = F.when(literal, F.col("_host")).otherwise(F.col("_ip"))
    reason = _reason(
        ("scheme", ~F.col("_scheme").isin(WEB_SCHEMES)),
        ("host", ~F.coalesce(F.col("_allowed"), F.lit(False))),
        ("unresolved", ip.isNull()),
        ("ip", addresses.is_blocked(ip)),
    )
    return joined.withColumn("reject_reason", reason).select(*df.columns, "reject_reason")


def seed_admission(df: DataFrame, allowed: DataFrame, url: str = "url") -> DataFrame:
    """Check submitted entry URLs: stripped `url`, and `reject_reason` scheme or host."""
    stripped = df.withColumn(url, strip(F.col(url)))
    parts = once(stripped, _scheme=urls.scheme_of(F.col(url)), _host=urls.host_of(F.col(url)))
    flags = allowed.select(F.col("host").alias("_host")).distinct().withColumn("_allowed", F.lit(True))
    reason = _reason(
        ("scheme", ~F.col("_scheme").isin(WEB_SCHEMES)),
        ("host", ~F.coalesce(F.col("_allowed"), F.lit(False))),
    )
    return (lookup(parts, flags, "_host").withColumn("reject_reason", reason)
            .select(*df.columns, "reject_reason"))
