"""Column functions for bundle ids, URLs and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BID_PATTERN = r"^bid:v1:[^:]+:[0-9]{14}:[0-9a-f]{8}$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mint_bid(registry, ts, seed) -> Column:
    """``bid:v1:{registry}:{yyyyMMddHHmmss}:{8 hex}``; the hex digits come from ``seed``, so that a
    retry mints the same id."""
    name = F.lower(F.replace(_c(registry), F.lit(" "), F.lit("-")))
    return F.concat_ws(":", F.lit("bid"), F.lit("v1"), name, F.date_format(_c(ts), "yyyyMMddHHmmss"), F.substring(F.sha2(_c(seed).cast("string"), 256), 1, 8))


def bid_parts(bid) -> Column:
    """struct(registry, bid_ts, rnd) of a bundle id; all null if it is not well-formed."""
    b = _c(bid)
    parts = F.split(b, ":")
    ok = b.rlike(BID_PATTERN)
    return F.struct(
        F.when(ok, parts[2]).alias("registry"),
        F.when(ok, F.try_to_timestamp(parts[3], F.lit("yyyyMMddHHmmss"))).alias("bid_ts"),
        F.when(ok, parts[4]).alias("rnd"),
    )


def bid_path(bid) -> Column:
    """``raw/{registry}/data/year=/month=/day=/{HH-mm-ss-hex}``."""
    p = bid_parts(bid)
    ts = p["bid_ts"]
    return F.concat(
        F.lit("raw/"), p["registry"], F.date_format(ts, "'/data/year='yyyy'/month='MM'/day='dd'/'HH-mm-ss"), F.lit("-"), p["rnd"]
    )


def run_id(config, ts) -> Column:
    return F.concat(F.lit("fetcher_"), _c(config), F.lit("_"), F.date_format(_c(ts), "yyyyMMddHHmmss"))


def strip_scheme(url) -> Column:
    return F.replace(_c(url), F.lit("sftp://"), F.lit(""))


def join_path(directory, name) -> Column:
    return F.concat_ws("/", F.regexp_replace(_c(directory), "/+$", ""), _c(name))


def url_path(url) -> Column:
    """The path of a URL: after the authority, up to query or fragment, path parameters dropped."""
    u = _c(url)
    rest = F.regexp_replace(F.regexp_replace(u, r"(?s)[?#].*$", ""), r"(?s)^[A-Za-z][A-Za-z0-9+.-]*:", "")
    path = F.regexp_replace(rest, r"(?s)^//[^/]*", "")
    return F.regexp_replace(path, r"(?s);[^/]*$", "")


def basename(path) -> Column:
    return F.regexp_extract(_c(path), r"(?s)([^/]*)$", 1)


def url_hash(url) -> Column:
    return F.substring(F.sha2(_c(url), 256), 1, 8)


def safe_name(url) -> Column:
    """A file name from a URL's path: ``index.html`` for none, one leading slash dropped, every
    character but letters, digits, ``_ - .`` replaced."""
    p = url_path(url)
    p = F.when((p == "") | (p == "/"), F.lit("index.html")).otherwise(F.regexp_replace(p, "^/", ""))
    return F.regexp_replace(p, r"(?U)[^\w\-_.]", "_")


def resource_name(url) -> Column:
    name = basename(url_path(url))
    return F.when(name == "", F.concat(F.lit("resource_"), url_hash(url))).otherwise(name)


def object_key(prefix, bid, url) -> Column:
    """``{prefix}/{bid}/{basename}``, or 8 hex digits of the URL's hash if its path has no basename."""
    name = basename(url_path(url))
    return F.concat_ws("/", _c(prefix), _c(bid), F.when(name == "", url_hash(url)).otherwise(name))


def strip_suffix(path, suffixes=(".tar.gz", ".tgz", ".gz", ".tar")) -> Column:
    """Drop the first of the suffixes that the path ends with."""
    longest = sorted(suffixes, key=len, reverse=True)
    return F.regexp_replace(_c(path), "(" + "|".join(s.replace(".", r"\.") for s in longest) + ")$", "")


def sniff(content) -> Column:
    """gzip, zip or tar by magic bytes, else null."""
    head = F.hex(F.substring(_c(content), 1, 2))
    return (
        F.when(head == "1F8B", "gzip").when(head == "504B", "zip").when(F.hex(F.substring(_c(content), 258, 5)) == "7573746172", "tar")
    )


def permissions(mode) -> Column:
    """A file mode as Python's oct() writes it."""
    return F.concat(F.lit("0o"), F.lower(F.conv(_c(mode).cast("string"), 10, 8)))


def prefixed_key(key, prefix) -> Column:
    p, k = _c(prefix), _c(key)
    return F.when(F.coalesce(p, F.lit("")) == "", k).when(p.endswith(":"), F.concat(p, k)).otherwise(F.concat(p, F.lit(":"), k))


def expires_at(put_at, ttl_s, default: int | None = None) -> Column:
    ttl = F.coalesce(_c(ttl_s), F.lit(default).cast("long"))
    return F.timestamp_seconds(F.unix_seconds(_c(put_at)) + ttl)


def encode_value(value) -> Column:
    """A state value as JSON: strings quoted, numbers and booleans bare, null as ``null``; rows,
    lists and maps by their fields, nulls included."""
    packed = F.to_json(F.struct(_c(value).alias("v")), {"ignoreNullFields": "false"})
    return F.regexp_extract(packed, r"(?s)^\{\"v\":(.*)\}$", 1)


def decode_value(text, schema: str | None = None) -> Column:
    """The value of such JSON: of the given type, or a variant, whose fields can be read by path."""
    if schema is None:
        return F.try_parse_json(_c(text))
    return F.from_json(F.concat(F.lit('{"v":'), _c(text), F.lit("}")), f"v {schema}")["v"]


def backoff(attempt, base: float = 1.0, factor: float = 2.0, most: float = 60.0, jitter_seed: int | None = None) -> Column:
    """Seconds to wait before the attempt; with a seed, between half and all of it at random."""
    delay = F.least(F.lit(base) * F.pow(F.lit(factor), _c(attempt)), F.lit(float(most)))
    return delay if jitter_seed is None else delay * (0.5 + 0.5 * F.rand(jitter_seed))


def query_string(params: dict, extra: Column | None = None) -> Column:
    """``a=1&b=2`` in the order given, no escaping; ``extra`` (a map) overrides and appends."""
    own = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in params.items()])
    if extra is None:
        return F.array_join(F.transform(own, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")
    more = F.coalesce(extra, F.create_map().cast("map<string,string>"))
    kept = F.transform(own, lambda e: F.struct(e["key"].alias("key"), F.coalesce(more[e["key"]], e["value"]).alias("value")))
    new = F.filter(F.map_entries(more), lambda e: ~e["key"].isin(*params))
    return F.array_join(F.transform(F.concat(kept, new), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")


def day_query(day, field: str = "date") -> Column:
    d = F.date_format(_c(day), "yyyy-MM-dd")
    return F.concat(F.lit(f"{field}:["), d, F.lit("T00:00:00%20TO%20"), d, F.lit("T23:59:59]"))


# The registry's date field and the conditions that every search carries.
REGISTRY_FIELD = "dateDernierTraitementUniteLegale"
REGISTRY_CONDITIONS = "-periode(categorieJuridiqueUniteLegale:1000) AND statutDiffusionUniteLegale:O"


def registry_query(day, narrowing=None) -> Column:
    """The day's search; a narrowing comes first, and ``siren:NN`` becomes ``siren:NN*``."""
    base = F.concat(F.lit(REGISTRY_CONDITIONS + " AND "), day_query(day, REGISTRY_FIELD))
    if narrowing is None:
        return base
    n = _c(narrowing)
    first = F.when(n.startswith("siren:"), F.concat(n, F.lit("*"))).otherwise(n)
    return F.when(F.coalesce(n, F.lit("")) == "", base).otherwise(F.concat(first, F.lit(" AND "), base))


def request_meta(json) -> Column:
    """Request meta from JSON with its defaults: depth 0, referer null, empty maps."""
    m = F.from_json(_c(json), "url string, depth int, referer string, headers map<string,string>, flags map<string,boolean>")
    return F.struct(
        m["url"].alias("url"), F.coalesce(m["depth"], F.lit(0)).alias("depth"), m["referer"].alias("referer"),
        F.coalesce(m["headers"], F.create_map().cast("map<string,string>")).alias("headers"),
        F.coalesce(m["flags"], F.create_map().cast("map<string,boolean>")).alias("flags"),
    )
