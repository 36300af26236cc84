"""URL rules by a sort-merge range join: intervals of canonical keys and a sorted sweep.

A rule has a host and a path. Its host's labels in reverse order form a key that all
its subdomains' keys start with, so the rule covers an interval of hosts. Pages and
rules are sorted by these keys and swept once: at each page, the rules whose interval
is still open form a stack. Intervals of rules with equally many labels never
overlap, so the stack needs one place per number of labels. Within each open rule
host, paths are swept in the same way: path prefixes are nested intervals, and the
end of each hands back to the rule around it. Of all rules that fit, the longest
(host and path together) decides; between equal rules ``block`` does.

Keys are compared as UTF-8 bytes. The sweeps are dealt out by ranges of key and page,
so a host with any share of the pages is spread over tasks.

Defined results: host and path are empty for a null url or one without ``://``, which
gets the default verdict, unless a rule fits the empty host. Repeated rows are judged
each for itself. An empty table gives no rows; urls of any length are read whole.
Extra columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from tabaudit.llm import frames
from tabaudit.session import materialize

DEFAULT = "allow"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_key(host: Column) -> Column:
    """The labels in reverse order, each followed by a dot, as bytes."""
    labels = F.reverse(F.split(host, "\\."))
    return F.concat(F.array_join(labels, "."), F.lit(".")).cast("binary")


def _starts_with(key: Column, prefix: Column) -> Column:
    return F.startswith(key, prefix)


def _open_hosts(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` with the array ``open`` of the rule hosts that cover each page's host."""
    hosts = rules.select("host").distinct()
    depth = F.size(F.split("host", "\\."))
    deepest = hosts.agg(F.max(depth)).first()[0] or 0
    if not deepest:
        return pages.withColumn("open", F.array().cast("array<string>"))
    places = [f"place{d}" for d in range(1, deepest + 1)]
    starts = hosts.select(
        host_key(F.col("host")).alias("key"),
        F.lit(0).alias("kind"),
        *[F.when(depth == d, F.col("host")).alias(p) for d, p in enumerate(places, 1)],
    )
    probes = pages.withColumns({"key": host_key(F.col("host")), "kind": F.lit(1)})
    events = probes.unionByName(starts, allowMissingColumns=True)
    swept = frames.carried(events, ["key", "kind", "page_id", "url"], places).filter("kind = 1")
    # A rule is on the stack as long as its interval is open, that is, its key still begins the page's.
    stack = F.array(
        *[F.when(_starts_with(F.col("key"), host_key(F.col(p))), F.col(p)) for p in places]
    )
    return swept.select(*pages.columns, F.array_compact(stack).alias("open"))


def _path_events(rules: DataFrame) -> DataFrame:
    """Starts and ends of the rules' path intervals, with the rule that holds from there on."""
    around = rules.select(
        "host", "path", F.explode(F.sequence(F.lit(0), F.length("path") - 1)).alias("n")
    ).filter(F.col("n") < F.length("path"))
    around = around.select("host", "path", F.expr("substring(path, 1, n)").alias("outer_path"))
    outer = rules.select("host", F.col("path").alias("outer_path"), F.col("verdict").alias("outer_verdict"))
    parents = around.join(outer, ["host", "outer_path"]).groupBy("host", "path").agg(
        F.max_by(F.struct("outer_path", "outer_verdict"), F.length("outer_path")).alias("parent")
    )
    nested = rules.join(parents, ["host", "path"], "left")
    holds = lambda path, verdict: F.struct(
        F.col("host").alias("host"), path.alias("path"), verdict.alias("verdict")
    ).alias("rule")
    starts = nested.select(
        F.col("host").alias("rule_host"),
        F.col("path").cast("binary").alias("place"),
        holds(F.col("path"), F.col("verdict")),
    )
    ends = nested.select(
        F.col("host").alias("rule_host"),
        # No UTF-8 text holds the byte FF, so this is above all that begin with the path.
        F.concat(F.col("path").cast("binary"), F.lit(b"\xff")).alias("place"),
        holds(F.col("parent.outer_path"), F.col("parent.outer_verdict")),
    )
    return starts.unionByName(ends).withColumn("kind", F.lit(0))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = DEFAULT,
) -> DataFrame:
    """``page_id``, ``url``, ``host``, ``path``, ``rule``, ``verdict`` for every row of ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``).
    """
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
    rules = materialize(rules, "url-rules")
    rows = frames.packed(pages).select(
        frames.field(id_col).alias("page_id"), frames.field(url_col).alias("url")
    )
    urls = rows.groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    split = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    opened = _open_hosts(split, rules)
    probes = opened.select(
        *split.columns, F.explode_outer("open").alias("rule_host"), F.lit(1).alias("kind")
    ).withColumn("place", F.col("path").cast("binary"))
    events = probes.unionByName(_path_events(rules), allowMissingColumns=True)
    order = ["rule_host", "place", "kind", "page_id", "url"]
    swept = frames.carried(events, order, ["rule"]).filter("kind = 1")
    fits = (F.col("rule.host") == F.col("rule_host")) & F.col("rule.path").isNotNull()
    found = F.when(
        fits,
        F.struct(
            (F.length("rule.host") + F.length("rule.path")).alias("length"),
            F.col("rule.verdict").alias("verdict"),
            F.concat("rule.host", "rule.path").alias("rule"),
        ),
    )
    best = swept.groupBy(*split.columns).agg(F.max(found).alias("best"))
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return best.select(
        "page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"), copies.alias("copy"),
    ).drop("copy")
