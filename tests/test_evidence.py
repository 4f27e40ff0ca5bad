"""Log evidence: parsing, out-of-order detection, checks, text-log readers."""

import os
import tempfile

from pyspark.sql import functions as F

from tidemark.operators import evidence as ev
from tidemark.sources.textlog import PARTITION_DIR, read_logs_lines, read_logs_whole

# Own short logs: an order desk with two log partitions; only the message formats are fixed.
OUT_OF_ORDER = """2031/11/02 04:40:00 ✓ Processed partition 6 offset 71: key=tea, value=3 boxes
2031/11/02 04:40:09 ✓ Processed partition 6 offset 70: key=salt, value=1 sack
2031/11/02 04:40:10 ✓ Committed partition 6 through offset 71
2031/11/02 04:41:30 ✓ Processed partition 6 offset 72: key=tea, value=exhausted retries
2031/11/02 04:41:31 Consumer caught up: processed 3/3 messages
2031/11/02 04:41:40 All in-flight consumer work drained"""

LATE_AFTER_COMMIT = """2031/11/03 10:00:00 ✓ Processed partition 2 offset 14: key=oats, value=a
2031/11/03 10:00:05 ✓ Committed partition 2 through offset 14
2031/11/03 10:00:06 ✓ Processed partition 2 offset 17: key=oats, value=b
2031/11/03 10:00:07 ✓ Processed partition 2 offset 16: key=rye, value=c"""

EXHAUSTED_REPLAY = """2031/11/04 23:59:01 Worker 5 processing partition 4 offset 9 attempt 1
2031/11/04 23:59:02 Message partition 4 offset 9 failed on attempt 1: mill is closed for key=barley attempt=1; retrying in 40ms
2031/11/04 23:59:03 Message partition 4 offset 9 failed on attempt 2: mill is closed for key=barley attempt=2; retrying in 1m2.5s
2031/11/04 23:59:04 Message partition 4 offset 9 exhausted retries; leaving offset uncommitted for replay on restart/rebalance
2031/11/05 06:30:00 ✓ Processed partition 4 offset 9: key=barley, value=12 sacks
2031/11/05 06:30:02 ✓ Committed partition 4 through offset 9
2031/11/05 06:30:03 Phase 2 consumer processed 1 replayed messages"""

NOTHING = """not a dated line
2031/11/06 08:15:00 the desk opens"""

LOGS = {"ooo": OUT_OF_ORDER, "late": LATE_AFTER_COMMIT, "exh": EXHAUSTED_REPLAY, "none": NOTHING}


def _lines(spark):
    rows = [(sc, i, ln) for sc, body in LOGS.items() for i, ln in enumerate(body.split("\n"))]
    return spark.createDataFrame(rows, "scenario string, line_idx bigint, line string")


def _bucket():
    return F.floor(F.col("line_idx") / F.lit(2)).cast("bigint")


def test_parse_kinds_and_fields(spark):
    p = ev.parse_log(_lines(spark)).where("scenario = 'exh'").orderBy("line_idx").collect()
    assert [r.kind for r in p] == ["processing", "retry", "retry", "exhausted", "processed", "committed"]
    assert [r.delay_ms for r in p[1:3]] == [40, 62500]
    assert (p[1].log_partition, p[1].log_offset, p[1].log_attempt, p[1].log_key) == (4, 9, 1, "barley")
    assert p[0].clock == "23:59:01"
    clocks = {r.line_idx: r.clock for r in ev.parse_log(_lines(spark)).where("scenario = 'ooo'").collect()}
    assert clocks[4] == "04:41:31"


def test_user_text_does_not_decide(spark):
    """Values, keys and errors of the user that read like messages."""
    log = ["2031/11/02 04:40:00 ✓ Processed partition 0 offset 5: key=k, value=exhausted retries",
           "2031/11/02 04:40:01 ✓ Processed partition 0 offset 3: key=a, b, value=✓ Committed partition 0 through offset 9",
           "2031/11/02 04:40:02 Message partition 0 offset 4 failed on attempt 2: Processed partition 0 offset 1; retrying in 5s; retrying in 100ms",
           "2031/11/02 04:40:03 note: ✓ Committed partition 0 through offset 1",
           "2031/11/02 04:40:04 ✓ Processed partition 0 offset 4: key=k, value=Worker 1 processing partition 7 offset 8 attempt 9",
           "✓ Committed partition 0 through offset 5"]
    lines = spark.createDataFrame([("s", i, ln) for i, ln in enumerate(log)], "scenario string, line_idx bigint, line string")
    got = [(r.line_idx, r.kind, r.log_partition, r.log_offset, r.log_attempt, r.log_key, r.delay_ms)
           for r in ev.parse_log(lines).orderBy("line_idx").collect()]
    assert got == [(0, "processed", 0, 5, None, "k", None), (1, "processed", 0, 3, None, "a, b", None), (2, "retry", 0, 4, 2, "", 100),
                   (4, "processed", 0, 4, None, "k", None), (5, "committed", 0, 5, None, None, None)]
    r = ev.out_of_order(ev.parse_log(lines), ["line_idx"], _bucket()).first()
    assert (r.out_of_order, r.late_completions) == (True, 2)


def test_rendered_durations(spark):
    given = {0: "0s", 40: "40ms", 1500: "1.5s", 62_500: "1m2.5s", 3_600_000: "1h0m0s", 3_723_000: "1h2m3s"}
    df = spark.createDataFrame([(k,) for k in given], "ms bigint")
    assert {r.ms: r.t for r in df.select("ms", ev.go_duration("ms").alias("t")).collect()} == given


def test_durations(spark):
    given = {"100ms": 100, "1h2m3s": 3_723_000, "1h0m0s": 3_600_000, "250µs": 0, "1500µs": 2, "2m": 120_000, "soon": None, "": None}
    df = spark.createDataFrame([(k,) for k in given], "t string")
    assert {r.t: r.ms for r in df.select("t", ev.duration_ms("t").alias("ms")).collect()} == given


def test_clock_without_date(spark):
    df = spark.createDataFrame([("not a dated line",), ("2031/11/06 08:15:00 x",)], "line string")
    assert [r.c for r in df.select(ev.log_clock("line").alias("c")).collect()] == ["time N/A", "08:15:00"]


def test_out_of_order_rule(spark):
    parsed = ev.parse_log(_lines(spark))
    got = {r.scenario: r.out_of_order for r in ev.out_of_order(parsed, ["line_idx"], _bucket()).collect()}
    # a late completion before the first commit counts; after it, it does not
    assert got == {"ooo": True, "late": False, "exh": False}


def test_scenario_checks_and_counts(spark):
    lines = _lines(spark)
    flags = ev.EXPECTATIONS
    scen = spark.createDataFrame(
        [("ooo", *[f in ("expect_catch_up", "expect_drain", "expect_out_of_order") for f in flags], None),
         ("exh", *[f == "expect_exhausted" for f in flags], "barley"),
         ("none", *[True for _ in flags], None)],
        "scenario string, " + ", ".join(f"{f} boolean" for f in flags) + ", replay_key string")
    ooo = ev.out_of_order(ev.parse_log(lines), ["line_idx"], _bucket())
    got = {r.scenario: r.summary for r in ev.scenario_checks(lines, scen, ooo).collect()}
    assert got["ooo"] == ("consumer completed catch-up; graceful drain logs appeared; real commit logs appeared; "
                          "out-of-order completion still committed only after the gap closed.")
    assert got["exh"] == ("real commit logs appeared; retry exhaustion was observed; "
                          "uncommitted message replay was observed.")
    assert got["none"] == "This scenario ran, but none of the expected summary checks were matched."
    cnt = {r.scenario: r.occurrences for r in ev.substring_count(lines, scen).collect()}
    assert cnt == {"exh": 3}


def test_keyword_filter_and_first_last(spark):
    lines = _lines(spark)
    kept = ev.keyword_filter(lines).where("scenario = 'ooo'").count()
    assert kept == 6  # every line of this excerpt holds a keyword
    fl = {(r.scenario, r.keyword): (r.first_clock, r.last_clock)
          for r in ev.first_last_clock(lines, ["line_idx"]).collect()}
    assert fl[("ooo", "Processed partition")] == ("04:40:00", "04:41:30")
    assert fl[("ooo", "Drain timeout reached")] == ("time N/A", "time N/A")
    assert fl[("none", "Phase 1")] == ("time N/A", "time N/A")


def test_text_log_readers_agree(spark):
    d = tempfile.mkdtemp(prefix="tidemark-logs-", dir="/tmp")
    for name, body in LOGS.items():
        with open(os.path.join(d, f"{name}.log"), "w") as f:
            f.write(body * 1 + "\n")
    big = "\n".join(f"2031/11/07 12:00:{i % 60:02d} ✓ Processed partition 0 offset {i}: key=k, value=v"
                    for i in range(3000))
    with open(os.path.join(d, "big.log"), "w") as f:
        f.write(big + "\n")
    whole = {(r.scenario, r.line_idx): r.line for r in read_logs_whole(spark, d + "/*.log").collect()}
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")  # several splits per big file
    try:
        lines = {(r.scenario, r.line_idx): r.line for r in read_logs_lines(spark, d + "/*.log").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    assert whole == lines
    assert whole[("big", 2999)].endswith("offset 2999: key=k, value=v")
    assert whole[("exh", 3)].startswith("2031/11/04 23:59:04 Message partition 4 offset 9 exhausted")


def test_part_files_follow_each_other_by_number(spark):
    d = tempfile.mkdtemp(prefix="tidemark-parts-", dir="/tmp")
    os.makedirs(f"{d}/scenario=a")
    for n, lines in ((99999, "second\nthird"), (100000, "fourth"), (7, "first")):
        with open(f"{d}/scenario=a/part-{n:05d}-x1.txt", "w") as f:
            f.write(lines + "\n")
    rows = read_logs_lines(spark, d + "/*/*.txt", PARTITION_DIR).orderBy("line_idx").collect()
    assert [(r.scenario, r.line_idx, r.line) for r in rows] == [("a", 0, "first"), ("a", 1, "second"), ("a", 2, "third"), ("a", 3, "fourth")]


def test_a_line_is_parsed_once(spark):
    """The clock is looked for once a line, in the plan of every field and of the filter."""
    lines = spark.createDataFrame([("s", 0, "2024/01/02 03:04:05 ✓ Committed partition 1 through offset 7"), ("s", 1, None), ("s", 2, "x"),
                                   ("s", 3, "Message partition 0 offset 2 failed on attempt 1: x key=a b; retrying in 1.5s")],
                                  "scenario string, line_idx bigint, line string").repartition(1)
    parsed = ev.parse_log(lines)
    assert str(parsed._jdf.queryExecution().optimizedPlan().toString()).count("^[0-9]{4}/") == 1
    assert [tuple(r) for r in parsed.orderBy("line_idx").collect()] == [
        ("s", 0, "committed", 1, 7, None, None, None, "03:04:05"), ("s", 3, "retry", 0, 2, 1, "a", 1500, ev.NO_TIME)]
