"""Log evidence: render run logs, parse them into typed events, and check them.

Log lines look like ``yyyy/MM/dd HH:mm:ss <message>``.  A log (one
"scenario") is a set of lines with an order key; for files read by
``sources.textlog`` the order key is the line index, for logs rendered from
the delivery tables it is (ts_ms, kind_rank, offset).  Every check is a
group-by with partial aggregation, or a two-level running max; no log is
ever joined into one string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import log_prefix, utc_date
from .prefix import running_agg

# Keywords of the log-excerpt filter, in their natural order.
KEYWORDS = [
    "Phase 1",
    "Phase 2",
    "Starting consumer group",
    "Produced message",
    "processing partition",
    "simulated transient failure",
    "retrying in",
    "exhausted retries",
    "Processed partition",
    "Committed partition",
    "simulated commit failure",
    "Observed expected scenario error",
    "Consumer caught up",
    "Consumer intake stopped",
    "Drain timeout reached",
    "All in-flight consumer work drained",
    "Consumer stopped after processing",
]

# Scenario checks in report order, as
# (expectation flag, marker searched in the log, sentence reported).
CHECKS = [
    ("expect_catch_up", "Consumer caught up:", "consumer completed catch-up"),
    ("expect_retry", "retrying in", "explicit retry/backoff logs appeared"),
    ("expect_drain", "All in-flight consumer work drained", "graceful drain logs appeared"),
    (None, "Committed partition", "real commit logs appeared"),
    ("expect_exhausted", "exhausted retries", "retry exhaustion was observed"),
    ("expect_drain_timeout", "Drain timeout reached", "drain timeout logs appeared"),
    ("expect_commit_failure", "simulated commit failure", "commit failure logs appeared"),
    ("expect_run_error", "Observed expected scenario error", "expected scenario error was observed"),
]
REPLAY_MARKER = "replayed messages"
REPLAY_SENTENCE = "uncommitted message replay was observed"
OUT_OF_ORDER_SENTENCE = "out-of-order completion still committed only after the gap closed"
NO_CHECK_SENTENCE = "This scenario ran, but none of the expected summary checks were matched."
NO_TIME = "time N/A"
EXPECTATIONS = [c[0] for c in CHECKS if c[0]] + ["expect_out_of_order"]

# Message formats of the modelled consumer.
FMT_PROCESSING = "Worker %d processing partition %d offset %d attempt %d"
FMT_RETRY = ("Message partition %d offset %d failed on attempt %d: "
             "simulated transient failure for key=%s attempt=%d; retrying in %s")
FMT_EXHAUSTED = ("Message partition %d offset %d exhausted retries (%d attempts); "
                 "leaving offset uncommitted for replay on restart/rebalance")
FMT_PROCESSED = "✓ Processed partition %d offset %d: key=%s, value=%s"
FMT_COMMITTED = "✓ Committed partition %d through offset %d"

# What a line begins with: the clock, then the message.
RX_CLOCK = r"^[0-9]{4}/[0-9]{2}/[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2} "
CLOCK_CHARS = 20
# Kind of message: (what it begins with, its whole format, the group of each field).
# A format covers the message from its first character, so text of the user inside it
# (keys, values, errors) never decides the kind or a field before it.
FORMATS = {
    "processing": ("Worker ", r"^Worker \d+ processing partition (\d+) offset (\d+) attempt (\d+)$",
                   {"partition": 1, "offset": 2, "attempt": 3}),
    "retry": ("Message partition ", r"(?s)^Message partition (\d+) offset (\d+) failed on attempt (\d+): (?:.*?key=([^,; ]*))?.*; retrying in (\S+)$",
              {"partition": 1, "offset": 2, "attempt": 3, "key": 4, "delay": 5}),
    "exhausted": ("Message partition ", r"(?s)^Message partition (\d+) offset (\d+) exhausted retries(?: \(\d+ attempts\))?; .*$",
                  {"partition": 1, "offset": 2}),
    "processed": ("✓ Processed partition ", r"(?s)^✓ Processed partition (\d+) offset (\d+): key=(.*?), value=.*$", {"partition": 1, "offset": 2, "key": 3}),
    "committed": ("✓ Committed partition ", r"^✓ Committed partition (\d+) through offset (\d+)$", {"partition": 1, "offset": 2}),
    "caught_up": ("Consumer caught up: ", r"^Consumer caught up: processed \d+/\d+ messages$", {}),
    "drain_timeout": ("Drain timeout reached ", r"^Drain timeout reached with \d+ in-flight jobs still active$", {}),
    "drained": ("All in-flight ", r"^All in-flight consumer work drained$", {}),
    "intake_stopped": ("Consumer intake stopped", r"(?s)^Consumer intake stopped; .*$", {}),
}


# -- rendering -----------------------------------------------------------------
def go_duration(ms) -> Column:
    """Go ``time.Duration`` text of whole milliseconds."""
    ms = F.col(ms) if isinstance(ms, str) else ms

    def secs(v):
        return F.regexp_replace(F.format_string("%.3f", v / F.lit(1000.0)), r"\.?0+$", "")

    return (F.when(ms == 0, F.lit("0s"))
            .when(ms < 1000, F.concat(ms.cast("string"), F.lit("ms")))
            .when(ms < 60000, F.concat(secs(ms), F.lit("s")))
            .otherwise(F.concat(F.when(ms >= 3600000, F.concat(F.floor(ms / 3600000).cast("string"), F.lit("h"))).otherwise(F.lit("")),
                                F.floor(ms % 3600000 / 60000).cast("string"), F.lit("m"), secs(ms % 60000), F.lit("s"))))


def render_log(attempt_rows: DataFrame, commits: DataFrame, workers: int = 2) -> DataFrame:
    """Log lines a consumer run prints, one log per UTC day.

    ``attempt_rows`` must carry the record ``value``.
    (scenario, ts_ms, kind_rank, partition, offset, attempt, line)
    """
    a = attempt_rows
    worker = F.col("offset") % F.lit(int(workers)) + 1
    start = a.select("partition", "offset", "attempt", F.col("start_ms").alias("ts_ms"),
                     F.lit(0).alias("kind_rank"),
                     F.format_string(FMT_PROCESSING, worker, "partition", "offset", "attempt").alias("body"))
    retry = a.where(~F.col("ok") & F.col("retry")).select(
        "partition", "offset", "attempt", F.col("end_ms").alias("ts_ms"), F.lit(1).alias("kind_rank"),
        F.format_string(FMT_RETRY, "partition", "offset", "attempt", "key", "attempt",
                        go_duration("delay_ms")).alias("body"))
    gave_up = a.where(~F.col("ok") & ~F.col("retry")).select(
        "partition", "offset", "attempt", F.col("end_ms").alias("ts_ms"), F.lit(2).alias("kind_rank"),
        F.format_string(FMT_EXHAUSTED, "partition", "offset", "attempt").alias("body"))
    done = a.where(F.col("ok")).select(
        "partition", "offset", "attempt", F.col("end_ms").alias("ts_ms"), F.lit(3).alias("kind_rank"),
        F.format_string(FMT_PROCESSED, "partition", "offset", "key", "value").alias("body"))
    com = commits.where(F.col("ok")).select(
        "partition", F.col("committed_through").alias("offset"), F.lit(0).alias("attempt"),
        F.col("commit_ms").alias("ts_ms"), F.lit(4).alias("kind_rank"),
        F.format_string(FMT_COMMITTED, "partition", "committed_through").alias("body"))
    lines = start.unionByName(retry).unionByName(gave_up).unionByName(done).unionByName(com)
    return lines.select(
        utc_date("ts_ms").alias("scenario"), "ts_ms", "kind_rank", "partition", "offset", "attempt",
        F.concat(log_prefix("ts_ms"), F.lit(" "), F.col("body")).alias("line"))


# -- parsing -------------------------------------------------------------------
def log_clock(line) -> Column:
    """``HH:MM:SS`` of a line whose first 19 characters hold a date, else N/A."""
    line = F.col(line) if isinstance(line, str) else line
    has = (F.length(line) >= 19) & F.substring(line, 1, 19).contains("/")
    return F.when(has, F.substring(line, 12, 8)).otherwise(F.lit(NO_TIME))


_UNIT_MS = {"h": 3_600_000.0, "m": 60_000.0, "s": 1_000.0, "ms": 1.0, "µs": 1e-3, "us": 1e-3, "ns": 1e-6}


def duration_ms(text) -> Column:
    """Milliseconds of duration text such as ``100ms``, ``1.5s``, ``1h2m3s`` or
    ``250µs`` (rounded); NULL if it is not one."""
    text = F.col(text) if isinstance(text, str) else text
    term = r"([0-9]+(?:\.[0-9]+)?)(h|ms|m|s|µs|us|ns)"
    unit = F.create_map(*[F.lit(x) for kv in _UNIT_MS.items() for x in kv])
    terms = F.arrays_zip(F.regexp_extract_all(text, F.lit(term), 1).alias("n"), F.regexp_extract_all(text, F.lit(term), 2).alias("u"))
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x["n"].cast("double") * F.element_at(unit, x["u"]))
    return F.when(text.rlike(rf"^(?:{term})+$"), F.round(total)).cast("bigint")


def message(line) -> Column:
    """The line without its clock."""
    ln = F.col(line) if isinstance(line, str) else line
    return F.when(ln.rlike(RX_CLOCK), ln.substr(F.lit(CLOCK_CHARS + 1), F.length(ln))).otherwise(ln)


def line_kind(line) -> Column:
    """Kind of a log line by its whole format (a cheap look at its beginning first)."""
    return _message_kind(message(line))


def _message_kind(msg: Column) -> Column:
    kind = None
    for name, (begin, rx, _) in FORMATS.items():
        cond = msg.startswith(begin) & msg.rlike(rx)
        kind = F.when(cond, F.lit(name)) if kind is None else kind.when(cond, F.lit(name))
    return kind


def parse_log(lines: DataFrame, line: str = "line") -> DataFrame:
    """One typed event per recognised line (other lines are dropped).

    Adds kind, log_partition, log_offset, log_attempt, log_key, delay_ms,
    clock to the input columns (minus the text).  Every kind has its own pattern
    over the whole message.

    The message and its kind are exploded from arrays of one: so they are computed once
    a line.  As plain columns they are put into each of their uses, some twenty, and
    into a filter below them.
    """
    keep = [c for c in lines.columns if c != line]
    with_message = lines.select("*", F.explode(F.array(message(line))).alias("_tm_message"))
    msg = F.col("_tm_message")
    typed = with_message.select("*", F.explode(F.array(_message_kind(msg))).alias("kind")).where(F.col("kind").isNotNull())

    def part(name: str) -> Column:
        out = None
        for kind, (_, rx, groups) in FORMATS.items():
            if name in groups:
                value = F.regexp_extract(msg, rx, groups[name])
                cond = F.col("kind") == kind
                out = F.when(cond, value) if out is None else out.when(cond, value)
        return out

    return typed.select(
        *keep, "kind",
        part("partition").cast("int").alias("log_partition"),
        part("offset").cast("bigint").alias("log_offset"),
        part("attempt").cast("int").alias("log_attempt"),
        part("key").alias("log_key"),
        duration_ms(part("delay")).alias("delay_ms"),
        log_clock(line).alias("clock"))


# -- checks --------------------------------------------------------------------
def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def keyword_filter(lines: DataFrame, line: str = "line", keywords: list[str] = KEYWORDS) -> DataFrame:
    """Lines holding any keyword, order columns kept; a null line holds none,
    without keywords no line stays."""
    cond = F.lit(False)
    for kw in keywords:
        cond = cond | F.col(line).contains(kw)
    return lines.where(cond)


def out_of_order(parsed: DataFrame, order: list[str], bucket: Column,
                 scenario: str = "scenario") -> DataFrame:
    """A processed offset lower than an earlier processed offset of the
    same partition, with the partition's first commit line after it.

    (scenario, out_of_order BOOLEAN, late_completions BIGINT), one row per
    scenario that has processed lines.
    """
    proc = parsed.where(F.col("kind") == "processed").select(scenario, *order, "log_partition", "log_offset")
    first_commit = (parsed.where(F.col("kind") == "committed")
                    .groupBy(scenario, "log_partition")
                    .agg(F.min(_order_struct(order)).alias("_first_commit")))
    run = running_agg(proc, [scenario, "log_partition"], order, bucket, "log_offset", "_prev_max",
                      how="max", inclusive=False)
    flagged = (run.join(first_commit, [scenario, "log_partition"], "left")
               .withColumn("_late", F.coalesce(F.col("_prev_max") > F.col("log_offset"), F.lit(False))
                           & F.coalesce(F.col("_first_commit") > _order_struct(order), F.lit(False))))
    return flagged.groupBy(scenario).agg(F.bool_or("_late").alias("out_of_order"),
                                         F.count_if("_late").alias("late_completions"))


def substring_count(lines: DataFrame, scenarios: DataFrame, line: str = "line",
                    scenario: str = "scenario", prefix: str = "key=") -> DataFrame:
    """Occurrences of ``<prefix><replay_key>`` per scenario (plain substring,
    non-overlapping, so ``key=key-1`` also hits ``key=key-10``).  Null lines hold
    none; the text searched must not be empty."""
    sc = scenarios.where(F.col("replay_key").isNotNull()).select(scenario, "replay_key")
    pat = F.concat(F.lit(prefix), F.col("replay_key"))
    cnt = F.floor((F.length(line) - F.length(F.replace(F.col(line), pat, F.lit(""))))
                  / F.length(pat)).cast("bigint")
    joined = lines.select(scenario, line).join(sc, scenario)
    return joined.groupBy(scenario, "replay_key").agg(F.coalesce(F.sum(cnt), F.lit(0)).cast("bigint").alias("occurrences"))


def first_last_clock(lines: DataFrame, order: list[str], line: str = "line",
                     scenario: str = "scenario") -> DataFrame:
    """First and last clock of every keyword per scenario, N/A if absent."""
    kws = F.array(*[F.lit(k) for k in KEYWORDS])
    hits = lines.select(scenario, *[c for c in order if c != scenario], log_clock(line).alias("clock"),
                        F.explode(F.filter(kws, lambda k: F.col(line).contains(k))).alias("keyword"))
    o = _order_struct(order)
    found = hits.groupBy(scenario, "keyword").agg(F.min_by("clock", o).alias("first_clock"),
                                                  F.max_by("clock", o).alias("last_clock"))
    every = lines.select(scenario).distinct().select(scenario, F.explode(kws).alias("keyword"))
    return (every.join(found, [scenario, "keyword"], "left")
            .select(scenario, "keyword",
                    F.coalesce("first_clock", F.lit(NO_TIME)).alias("first_clock"),
                    F.coalesce("last_clock", F.lit(NO_TIME)).alias("last_clock")))


def scenario_checks(lines: DataFrame, scenarios: DataFrame, ooo: DataFrame,
                    line: str = "line", scenario: str = "scenario") -> DataFrame:
    """The ordered check sentences a scenario's log satisfies.

    ``scenarios``: (scenario, expect_* BOOLEAN..., replay_key); ``ooo``: the
    result of ``out_of_order``.  One pass over the lines computes every
    marker and the replay-key count.  (scenario, summary)
    """
    ln = F.col(line)
    keys = scenarios.select(scenario, "replay_key")
    pat = F.concat(F.lit("key="), F.col("replay_key"))
    hits = F.floor((F.length(ln) - F.length(F.replace(ln, pat, F.lit("")))) / F.length(pat))
    markers = [F.bool_or(ln.contains(m)).alias(f"_has{i}") for i, (_, m, _) in enumerate(CHECKS)]
    markers.append(F.bool_or(ln.contains(REPLAY_MARKER)).alias("_replayed"))
    markers.append(F.sum(hits).cast("bigint").alias("occurrences"))
    seen = lines.select(scenario, line).join(keys, scenario, "left").groupBy(scenario).agg(*markers)
    s = (scenarios.join(seen, scenario, "left")
         .join(ooo.select(scenario, "out_of_order"), scenario, "left"))
    parts = []
    for i, (flag, _, sentence) in enumerate(CHECKS):
        cond = F.coalesce(F.col(f"_has{i}"), F.lit(False))
        if flag:
            cond = F.col(flag) & cond
        parts.append(F.when(cond, F.lit(sentence)))
    replay = (F.col("replay_key").isNotNull()
              & ((F.coalesce(F.col("occurrences"), F.lit(0)) >= 2)
                 | F.coalesce(F.col("_replayed"), F.lit(False))))
    parts.append(F.when(replay, F.lit(REPLAY_SENTENCE)))
    parts.append(F.when(F.col("expect_out_of_order") & F.coalesce(F.col("out_of_order"), F.lit(False)),
                        F.lit(OUT_OF_ORDER_SENTENCE)))
    joined = F.concat_ws("; ", *parts)
    summary = F.when(joined == "", F.lit(NO_CHECK_SENTENCE)).otherwise(F.concat(joined, F.lit(".")))
    return s.select(scenario, summary.alias("summary"))


def derived_scenarios(parsed: DataFrame, order: list[str], scenario: str = "scenario",
                      expected: Callable[[int], Column] = lambda i: F.lit(True)) -> DataFrame:
    """Scenario table of logs: expectation i is on where ``expected(i)`` holds; the
    replay key is the key of the scenario's first failed try."""
    retry = parsed.where(F.col("kind") == "retry")
    keys = retry.groupBy(scenario).agg(F.min_by("log_key", _order_struct(order)).alias("replay_key"))
    base = parsed.select(scenario).distinct()
    flags = [expected(i).alias(f) for i, f in enumerate(EXPECTATIONS)]
    return base.join(keys, scenario, "left").select(scenario, *flags, "replay_key")
