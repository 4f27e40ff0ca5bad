"""Evidence checks: each expectation with logs that bear it out and logs that do not.

Sentences come from the fixed list of the checks, in its order."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import evidence as ev

DAY = "2030/07/01 "
LINES = {
    "caught": "Consumer caught up: processed 4/4 messages",
    "retry": "Message partition 5 offset 31 failed on attempt 1: no stock for key=plum attempt=1; retrying in 70ms",
    "drained": "All in-flight consumer work drained",
    "gone": "Message partition 5 offset 31 exhausted retries; leaving offset uncommitted for replay on restart/rebalance",
    "late": "Drain timeout reached with 2 in-flight jobs still active",
    "commit": "✓ Committed partition 5 through offset 32",
    "done31": "✓ Processed partition 5 offset 31: key=plum, value=7",
    "done32": "✓ Processed partition 5 offset 32: key=pear, value=8",
}
# case: (expectations, replay key, lines, words that the summary has, words that it has not)
CASES = {
    "caught-up": ({"expect_catch_up"}, None, ["done31", "caught"], ["catch-up"], ["retry", "drain"]),
    "not-caught-up": ({"expect_catch_up"}, None, ["done31"], ["none of the expected"], ["catch-up"]),
    "not-asked": (set(), None, ["caught", "retry", "drained"], ["none of the expected"], ["catch-up", "retry"]),
    "retried": ({"expect_retry"}, None, ["retry", "done31"], ["retry"], ["catch-up"]),
    "never-retried": ({"expect_retry"}, None, ["done31"], ["none of the expected"], ["backoff"]),
    "drained": ({"expect_drain"}, None, ["drained"], ["drain"], ["timeout"]),
    "drain-late": ({"expect_drain_timeout"}, None, ["late"], ["drain timeout"], ["graceful"]),
    "drain-in-time": ({"expect_drain_timeout"}, None, ["drained"], ["none of the expected"], ["drain timeout"]),
    "out-of-order": ({"expect_out_of_order"}, None, ["done32", "done31", "commit"], ["out-of-order"], []),
    "in-order": ({"expect_out_of_order"}, None, ["done31", "done32", "commit"], ["commit"], ["out-of-order"]),
    "given-up": ({"expect_exhausted"}, None, ["retry", "gone"], ["exhaustion"], ["replay was"]),
}


@pytest.fixture(scope="module")
def summaries(spark):
    lines = [(case, i, DAY + f"09:00:{i:02d} " + LINES[k]) for case, (_, _, body, _, _) in CASES.items() for i, k in enumerate(body)]
    df = spark.createDataFrame(lines, "scenario string, line_idx bigint, line string")
    flags = ev.EXPECTATIONS
    scen = spark.createDataFrame([(case, *[f in on for f in flags], key) for case, (on, key, *_) in CASES.items()],
                                 "scenario string, " + ", ".join(f"{f} boolean" for f in flags) + ", replay_key string")
    ooo = ev.out_of_order(ev.parse_log(df), ["line_idx"], F.floor(F.col("line_idx") / 2))
    return {r.scenario: r.summary for r in ev.scenario_checks(df, scen, ooo).collect()}


@pytest.mark.parametrize("case", list(CASES))
def test_summary(summaries, case):
    _, _, _, has, lacks = CASES[case]
    assert all(w in summaries[case] for w in has) and not any(w in summaries[case] for w in lacks)
