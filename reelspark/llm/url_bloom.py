"""URL filter: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

A listed entry is ``host/path``; it covers its host with all subdomains, and all paths that begin with it, a query
included. Entries and URLs are looked up in one canonical form (``canonical``), while rules and results keep the host and
path as they stand in the URL. An entry without a path covers the whole host; one with a port that isn't the default
covers that port only. The keys of a URL are its ``host suffix + path prefix`` forms of those shapes (labels of the host,
characters of the path) that the list has, so their number doesn't grow with the URL. Each key sets or tests four bits
within one block of 64, so a probe touches one word. The filter is sized by the list up to a bound, and passes only
possible hits to an exact hash join with the list, which takes out the false positives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialize

#: (kind, host, path)
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
#: The block list of production: hosts of spam farms, which are named by two words of this trade, and trackers by URL.
FIRST = (
    "adult ads affiliate bargain bet bets big bonus buy cash casino cheap click crypto date diet discount easy fake fast free fx gold hot instant jackpot link loan loans "
    "lotto lucky luxury meds money pharma pills poker porn prize promo quick replica rich rx sale sex slim slots spam super top traffic viagra vip win xxx"
).split()
LAST = (
    "ads bank bets bonus box cams cash casino chat city click club coins deals dates farm farms finder games girls hits hub king kings land link links live loans lotto mart meds money now "
    "offers online outlet palace pharmacy pills play poker prizes profit seo shop slots spins store surf track traffic videos watches win wins world x xxx zone"
).split()
ZONES = ("example.com", "example.net", "example.org")
TRACKERS = ("count.example.net/pixel", "go.example.org/out?to=", "www.example.net:8080/feed/spam/")
LISTED = tuple(f"{a}-{b}.{z}/" for a in FIRST for b in LAST for z in ZONES) + TRACKERS
#: Bits of the filter for each entry, and its least and most words of 64 bits (16 MB); a longer list only lets more pass.
BITS = 16
LEAST_WORDS, MOST_WORDS = 1 << 10, 1 << 21


def with_parts(pages: DataFrame, *more: str) -> DataFrame:
    """page_id, host, path, and further columns."""
    url = F.col("url")
    rest = F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    authority = F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.select(F.col("page_id").cast("long").alias("page_id"), rest.alias("_rest"), *more).select(
        "page_id", F.coalesce(F.translate(authority, upper, lower), F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), *more
    )


def rule_column(what: str, rules=RULES):
    """The longest rule that fits (``what``: its name or its verdict), else null."""
    out = F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.lit(host + path if what == "rule" else kind)).otherwise(out)
    return out


def _escapes(x):
    """Escapes of letters, digits and -._~ resolved, all others in upper case, and characters beyond ASCII escaped."""

    def piece(t, i):
        char = F.chr(F.conv(F.substring(t, 1, 2), 16, 10).cast("int"))
        rest = F.substr(t, F.lit(3))
        known = F.when(char.rlike(r"^[A-Za-z0-9._~-]$"), F.concat(char, rest)).otherwise(F.concat(F.lit("%"), F.upper(F.substring(t, 1, 2)), rest))
        return F.when(i == 0, t).when(t.rlike("^[0-9A-Fa-f]{2}"), known).otherwise(F.concat(F.lit("%"), t))

    plain = F.when(x.contains("%"), F.array_join(F.transform(F.split(x, "%"), piece), "")).otherwise(x)
    odd = F.transform(F.split(plain, ""), lambda c: F.when(c.rlike(r"[^\x00-\x7f]"), F.url_encode(c)).otherwise(c))
    return F.when(plain.rlike(r"[^\x00-\x7f]"), F.array_join(odd, "")).otherwise(plain)


def _without_dots(path):
    """A path with its ``.`` and ``..`` resolved."""
    parts = F.split(path, "/")
    parts = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    up = lambda a: F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(1)))
    fold = F.aggregate(parts, F.array().cast("array<string>"), lambda a, t: F.when(t == ".", a).when(t == "..", up(a)).otherwise(F.concat(a, F.array(t))))
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.array_join(fold, "/")).otherwise(path)


def canonical(df: DataFrame, url, scheme: str = "[^/?#]*?") -> DataFrame:
    """``df`` with _site, _port and _where of a URL: the host in lower case, without userinfo, escapes and final dots; the
    port with its colon, empty if it is the default of the scheme (without a scheme, 80 or 443); path and query with
    escapes and dots settled, at least ``/``. Names beyond ASCII are not turned into Punycode."""
    df = df.withColumn("_scheme", F.lower(F.regexp_extract(url, f"(?s)^({scheme})://", 1))).withColumn("_rest", F.regexp_replace(url, f"(?s)^{scheme}://", ""))
    df = df.withColumn("_authority", F.regexp_replace(F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1), r"(?s)^.*@", ""))
    df = df.withColumn("_port", F.regexp_extract("_authority", r":([0-9]*)$", 1)).withColumn("_query", F.regexp_extract("_rest", r"(?s)^[^?#]*(\?[^#]*)", 1))
    default = F.when(F.col("_scheme") == "http", F.col("_port") == "80").when(F.col("_scheme") == "https", F.col("_port") == "443").otherwise(F.col("_port").isin("80", "443"))
    site = F.regexp_replace(F.lower(_escapes(F.regexp_replace("_authority", r":[0-9]*$", ""))), r"\.+$", "")
    path = _without_dots(_escapes(F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1)))
    df = df.withColumns({"_site": F.coalesce(site, F.lit("")), "_where": F.coalesce(F.concat(F.when(path == "", F.lit("/")).otherwise(path), _escapes(F.col("_query"))), F.lit("/"))})
    return df.withColumn("_port", F.when((F.col("_port") == "") | default, F.lit("")).otherwise(F.coalesce(F.concat(F.lit(":"), "_port"), F.lit("")))).drop("_scheme", "_rest", "_authority", "_query")


def listed_keys(site, port, where, shapes):
    """The forms under which a URL could be listed: for each shape (labels, chars) of the list the host's last labels, with
    the port and without, and so many characters of path and query."""
    labels = F.split(site, r"\.")
    fits = F.filter(shapes, lambda x: (x["labels"] <= F.size(labels)) & (x["chars"] <= F.length(where)))
    host = lambda x: F.array_join(F.slice(labels, F.size(labels) - x["labels"] + 1, x["labels"]), ".")
    head = lambda x: F.substr(where, F.lit(1), x["chars"])
    plain = F.transform(fits, lambda x: F.concat(host(x), head(x)))
    return F.when(port == "", plain).otherwise(F.concat(plain, F.transform(fits, lambda x: F.concat(host(x), port, head(x)))))


def _bits(key):
    """The four bits of a key within its block."""
    h = F.xxhash64(key, F.lit(1))
    ones = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
    return reduce(lambda a, b: a.bitwiseOR(b), ones)


def _word(key, words: int):
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def words_for(entries: int) -> int:
    """Words of a filter for so many entries: a power of two within the bounds."""
    return min(MOST_WORDS, max(LEAST_WORDS, 1 << max(0, (entries * BITS - 1) // 64).bit_length()))


def bloom(listed: DataFrame, words: int) -> DataFrame:
    """One row with ``filter``: an array of ``words`` longs. Built by aggregation; the list is never collected."""
    spark = listed.sparkSession
    set_ = listed.groupBy(_word(F.col("key"), words).alias("w")).agg(F.bit_or(_bits(F.col("key"))).alias("bits"))
    every = spark.range(words).select(F.col("id").cast("int").alias("w"))
    filled = every.join(set_, "w", "left").select("w", F.coalesce("bits", F.lit(0)).alias("bits"))
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"]).alias("filter"))


def listed_table(spark: SparkSession, entries=LISTED) -> DataFrame:
    return spark.createDataFrame([(e,) for e in entries], "key string")


def prepared(listed: DataFrame, words: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """The canonical list (key, labels, chars), one row with its filter and shapes, and the words of the filter."""
    entries = canonical(listed.where("key is not null").select("key"), F.col("key")).where("_site <> ''")
    shape = F.size(F.split("_site", r"\.")).alias("labels"), F.length("_where").alias("chars")
    listed = materialize(entries.select(F.concat("_site", "_port", "_where").alias("key"), *shape).distinct(), "listed")
    words = words or words_for(listed.count())
    shapes = listed.agg(F.array_sort(F.collect_set(F.struct("labels", "chars"))).alias("shapes"))
    return listed, materialize(bloom(listed, words).crossJoin(shapes), "bloom"), words


def probe(pages: DataFrame, filtered: DataFrame, words: int, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, ruled, _url, and hits: the forms of a URL without a rule that pass the filter."""
    parts = with_parts(canonical(pages, F.col("url"), ".*?"), "_site", "_port", "_where").withColumn("rule", rule_column("rule", rules)).withColumn("ruled", rule_column("kind", rules))
    bits = F.broadcast(filtered)  # one row: 8 * words bytes and the shapes
    open_ = F.col("ruled").isNull() & (F.col("host") != "")
    test = lambda k: F.get(F.col("filter"), _word(k, words)).bitwiseAND(_bits(k)) == _bits(k)
    keys = listed_keys(F.col("_site"), F.col("_port"), F.col("_where"), F.col("shapes"))
    hits = F.when(open_, F.filter(keys, test)).otherwise(F.array().cast("array<string>"))
    return parts.crossJoin(bits).select("page_id", "host", "path", "rule", "ruled", F.concat("_site", "_port", "_where").alias("_url"), hits.alias("hits"))


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES, words: int | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. listed: a column key, of entries ``host/path``; words: those of
    the filter, by default as many as the list asks for.

    A url that is null or has no ``://`` has an empty host and path, fits no rule and is allowed. Null and repeated
    entries of the list, and repeated pages, are fine, and an entry without a host covers nothing; a null page_id stays
    null; very long URLs are looked up in as many forms as others; other columns are ignored; an empty list blocks nothing;
    an empty table gives an empty result."""
    listed, filtered, words = prepared(listed, words)
    probed = probe(pages, filtered, words, rules)
    # the few possible hits go to the exact join, by the URL itself: repeated URLs are looked up once
    possible = probed.where(F.size("hits") > 0).select("_url", F.explode("hits").alias("key")).distinct()
    sure = possible.join(listed, "key").select("_url").distinct().withColumn("listed", F.lit(True))
    out = probed.join(materialize(sure, "listed-urls"), "_url", "left")
    verdict = F.coalesce("ruled", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
