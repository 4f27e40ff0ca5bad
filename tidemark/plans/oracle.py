"""Oracle SQL: the same queries written directly for a single-node engine.

Tables are the pre-registered parquet views.  The oracle uses plain
per-partition windows (no buckets), so it is an independent check of the
bucketed Spark plans.  Its parameters are written out here, not taken from
the code that it checks.
"""

from __future__ import annotations

# Written out here too: keywords, checks (marker, sentence, number of its expectation) and message formats.
KEYWORDS = [
    "Phase 1", "Phase 2", "Starting consumer group", "Produced message", "processing partition", "simulated transient failure", "retrying in",
    "exhausted retries", "Processed partition", "Committed partition", "simulated commit failure", "Observed expected scenario error",
    "Consumer caught up", "Consumer intake stopped", "Drain timeout reached", "All in-flight consumer work drained",
    "Consumer stopped after processing"]
CHECKS = [
    ("Consumer caught up:", "consumer completed catch-up", 0),
    ("retrying in", "explicit retry/backoff logs appeared", 1),
    ("All in-flight consumer work drained", "graceful drain logs appeared", 2),
    ("Committed partition", "real commit logs appeared", None),
    ("exhausted retries", "retry exhaustion was observed", 3),
    ("Drain timeout reached", "drain timeout logs appeared", 4),
    ("simulated commit failure", "commit failure logs appeared", 5),
    ("Observed expected scenario error", "expected scenario error was observed", 6)]
OUT_OF_ORDER_CHECK = 7


def _expected(i: int | None) -> str:
    return "true" if i is None else f"(day(CAST(s.scenario AS DATE)) + {i}) % 3 <> 0"


INF = (1 << 63) - 1
# 3 retries, 100 ms base, 1 s cap: waits, and waits before try 1, 2, 3, 4.
N = 3
DELAYS = (100, 200, 400)
DELAY_LIST = "[100, 200, 400]"
SUMS = "[0, 100, 300, 700]"
OVERRIDES = "('key-0', 900), ('key-3', 50), ('key-5', 50)"
P = 3
RESTART_AT_MS = 1706745600000
T = 1706597329737
CUT = 1706597334737
FAIL_FROM = 1705708800000

CTES = f"""
ev AS (
  SELECT event_id AS seq, user_id, event_type,
         CAST(epoch_us(ts) // 1000 AS BIGINT) AS fetched_ms,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         'key-' || CAST(user_id AS VARCHAR) AS key,
         'message-' || CAST(event_id AS VARCHAR) || ': ' || event_type AS value
  FROM events),
hashed AS (
  SELECT *, list_reduce([CAST(2166136261 AS BIGINT)] || list_transform(range(1, length(key) + 1),
              lambda i: CAST(ascii(substr(key, CAST(i AS INTEGER), 1)) AS BIGINT)),
            lambda h, b: (xor(h, b) * 16777619) % 4294967296) AS h
  FROM ev),
keyed AS (
  SELECT *, CAST(abs((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {P}) AS INTEGER) AS "partition"
  FROM hashed),
records AS (
  SELECT "partition", CAST(row_number() OVER (PARTITION BY "partition" ORDER BY seq) - 1 AS BIGINT) AS "offset",
         key, value, fetched_ms, seq, event_type, k
  FROM keyed),
handled AS (
  SELECT r.*, CAST(CASE WHEN r.event_type <> 'error' THEN 0
                          WHEN r."partition" = 0 AND r.fetched_ms >= 1706572800000 THEN r.k % 6
                          ELSE r.k % 4 END AS INTEGER) AS failures,
         CAST(COALESCE(o.override_ms, 1000 * r.k) AS BIGINT) AS latency_ms
  FROM records r LEFT JOIN (VALUES {OVERRIDES}) o(okey, override_ms) ON r.key = o.okey),
outcomes AS (
  SELECT "partition", "offset", key, CAST(least(failures, {N}) + 1 AS INTEGER) AS attempts,
         CASE WHEN failures <= {N} THEN 'done' ELSE 'exhausted' END AS status,
         CAST(CASE WHEN failures <= {N} THEN fetched_ms + (least(failures, {N}) + 1) * latency_ms
                   + {SUMS}[least(failures, {N}) + 1] END AS BIGINT) AS done_ms,
         CAST(fetched_ms + (least(failures, {N}) + 1) * latency_ms + {SUMS}[least(failures, {N}) + 1] AS BIGINT) AS end_ms
  FROM handled),
tries AS (
  SELECT *, unnest(range(1, least(failures, {N}) + 2)) AS a FROM handled),
attempts AS (
  SELECT "partition", "offset", key, CAST(a AS INTEGER) AS attempt,
         CAST(fetched_ms + (a - 1) * latency_ms + {SUMS}[a] AS BIGINT) AS start_ms,
         CAST(fetched_ms + a * latency_ms + {SUMS}[a] AS BIGINT) AS end_ms,
         a > failures AS ok,
         CASE WHEN a <= failures THEN '{"simulated transient failure"}' END AS error,
         (a <= failures AND a BETWEEN 1 AND {N}) AS retry,
         CAST(CASE WHEN a <= failures AND a BETWEEN 1 AND {N} THEN {DELAY_LIST}[least(a, {len(DELAYS)})] ELSE 0 END AS BIGINT) AS delay_ms
  FROM tries),
base AS (
  SELECT "partition", CAST(min("offset") - 1 AS BIGINT) AS base FROM records GROUP BY 1),
eff AS (
  SELECT "partition", "offset", done_ms, CASE WHEN done_ms IS NULL THEN {INF} ELSE done_ms END AS e FROM outcomes),
ctimes AS (
  SELECT "partition", "offset", done_ms,
         CASE WHEN c < {INF} THEN c END AS commit_ms
  FROM (SELECT *, max(e) OVER (PARTITION BY "partition" ORDER BY "offset"
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM eff)),
timeline AS (
  SELECT "partition", commit_ms, max("offset") AS committed_through, count(*) AS released
  FROM ctimes WHERE commit_ms IS NOT NULL GROUP BY 1, 2),
commits AS (
  SELECT "partition", committed_through, commit_ms, true AS ok FROM timeline),
snap AS (
  SELECT b."partition", b.base, CAST(COALESCE(max(c."offset"), b.base) AS BIGINT) AS last_committed
  FROM base b LEFT JOIN ctimes c ON c."partition" = b."partition" AND c.commit_ms IS NOT NULL
  GROUP BY 1, 2),
final_commit AS (
  SELECT "partition", max(committed_through) AS committed_through FROM commits WHERE ok GROUP BY 1),
donek AS (
  SELECT o."partition", o."offset", o.done_ms, h.k, h.fetched_ms
  FROM outcomes o JOIN handled h ON o."partition" = h."partition" AND o."offset" = h."offset" WHERE o.done_ms IS NOT NULL),
comps AS (
  SELECT "partition", "offset", done_ms FROM donek
  UNION ALL SELECT "partition", "offset", done_ms + 1000 FROM donek WHERE k % 10 = 0
  UNION ALL SELECT "partition" + 3, "offset", done_ms FROM donek WHERE k % 50 = 7
  UNION ALL SELECT "partition", "offset" + 1099511627776, done_ms FROM donek WHERE k % 50 = 8
  UNION ALL SELECT "partition", "offset", done_ms FROM donek WHERE k % 50 = 9
  UNION ALL SELECT "partition", "offset", fetched_ms - 1 FROM donek WHERE k % 50 = 6),
split0 AS (
  SELECT o."partition", o."offset", o.key, r.fetched_ms, o.status, o.done_ms,
         CASE WHEN r.fetched_ms >= {T} THEN 'not_dispatched' WHEN o.end_ms <= {T} THEN 'finished'
              WHEN o.end_ms <= {CUT} THEN 'drained' ELSE 'unfinished' END AS split
  FROM outcomes o JOIN records r ON r."partition" = o."partition" AND r."offset" = o."offset"),
split AS (
  SELECT "partition", "offset", key, fetched_ms, split,
         CASE WHEN split IN ('finished', 'drained') THEN status ELSE split END AS final_status,
         CASE WHEN split IN ('finished', 'drained') THEN done_ms END AS done_ms
  FROM split0),
ct1 AS (
  SELECT "partition", "offset", done_ms, CASE WHEN c < {INF} THEN c END AS commit_ms
  FROM (SELECT *, max(CASE WHEN done_ms IS NULL THEN {INF} ELSE done_ms END) OVER (
          PARTITION BY "partition" ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
        FROM split)),
snap1 AS (
  SELECT b."partition", b.base, CAST(COALESCE(max(c."offset"), b.base) AS BIGINT) AS last_committed
  FROM base b LEFT JOIN ct1 c ON c."partition" = b."partition" AND c.commit_ms IS NOT NULL
  GROUP BY 1, 2),
fc1 AS (
  SELECT "partition", max("offset") AS committed_through FROM ct1 WHERE commit_ms IS NOT NULL GROUP BY 1),
replay AS (
  SELECT s."partition", s."offset", s.key,
         CASE WHEN s.final_status = 'done' THEN 'blocked_done' ELSE s.final_status END AS reason
  FROM split s JOIN snap1 n ON n."partition" = s."partition" WHERE s."offset" > n.last_committed),
withfetch AS (
  SELECT o.*, r.fetched_ms FROM outcomes o JOIN records r ON r."partition" = o."partition" AND r."offset" = o."offset"),
second AS (
  SELECT r."partition", r."offset", CASE WHEN h.failures <= 4 THEN {RESTART_AT_MS} + h.latency_ms END AS done_ms
  FROM replay r JOIN handled h ON h."partition" = r."partition" AND h."offset" = r."offset"),
succ AS (
  SELECT "partition", "offset" FROM split WHERE final_status = 'done'
  UNION ALL SELECT "partition", "offset" FROM second WHERE done_ms IS NOT NULL),
cutat AS (
  SELECT COALESCE(min(commit_ms), 4611686018427387904) AS stop FROM timeline WHERE commit_ms >= {FAIL_FROM}),
cutrun AS (
  SELECT "partition", "offset", CASE WHEN fetched_ms < stop AND end_ms <= stop + 5000 THEN done_ms END AS done_ms
  FROM withfetch, cutat),
cf AS (
  SELECT "partition", max("offset") AS committed_through, c AS commit_ms, c < {FAIL_FROM} AS ok
  FROM (SELECT *, max(COALESCE(done_ms, {INF})) OVER (
          PARTITION BY "partition" ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
        FROM cutrun)
  WHERE c < {INF} GROUP BY "partition", c),
attv AS (
  SELECT a.*, r.value || CASE r.k % 25 WHEN 11 THEN '; exhausted retries' WHEN 12 THEN '; ✓ Committed partition 0 through offset 3'
                                       WHEN 13 THEN '; failed on attempt 1: x; retrying in 5ms' ELSE '' END AS value
  FROM attempts a JOIN records r ON r."partition" = a."partition" AND r."offset" = a."offset"),
lines0 AS (
  SELECT "partition", "offset", attempt, start_ms AS ts_ms, 0 AS kind_rank,
         printf('Worker %d processing partition %d offset %d attempt %d', "offset" % 2 + 1, "partition", "offset", attempt) AS body FROM attv
  UNION ALL
  SELECT "partition", "offset", attempt, end_ms, 1,
         printf('Message partition %d offset %d failed on attempt %d: simulated transient failure for key=%s attempt=%d; retrying in %s', "partition", "offset", attempt, key, attempt,
                CASE WHEN delay_ms = 0 THEN '0s' WHEN delay_ms < 1000 THEN CAST(delay_ms AS VARCHAR) || 'ms'
                     ELSE regexp_replace(printf('%.3f', delay_ms / 1000.0), '\\.?0+$', '') || 's' END)
  FROM attv WHERE NOT ok AND retry
  UNION ALL
  SELECT "partition", "offset", attempt, end_ms, 2,
         printf('Message partition %d offset %d exhausted retries (%d attempts); leaving offset uncommitted for replay on restart/rebalance', "partition", "offset", attempt) FROM attv WHERE NOT ok AND NOT retry
  UNION ALL
  SELECT "partition", "offset", attempt, end_ms, 3,
         printf('✓ Processed partition %d offset %d: key=%s, value=%s', "partition", "offset", key, value) FROM attv WHERE ok
  UNION ALL
  SELECT "partition", committed_through, 0, commit_ms, 4,
         printf('✓ Committed partition %d through offset %d', "partition", committed_through) FROM commits WHERE ok),
loglines AS (
  SELECT strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS scenario, ts_ms, kind_rank, "partition", "offset",
         attempt, strftime(make_timestamp(ts_ms * 1000), '%Y/%m/%d %H:%M:%S') || ' ' || body AS line
  FROM lines0),
parsed AS (
  SELECT scenario, ts_ms, kind_rank, "partition", "offset", attempt, kind,
         CAST(regexp_extract(msg, 'partition ([0-9]+)', 1) AS INTEGER) AS log_partition,
         CAST(regexp_extract(msg, 'offset ([0-9]+)', 1) AS BIGINT) AS log_offset,
         CAST(CASE WHEN kind IN ('retry', 'processing') THEN regexp_extract(msg, 'attempt ([0-9]+)', 1) END AS INTEGER) AS log_attempt,
         CASE WHEN kind IN ('retry', 'processed') THEN regexp_extract(msg, 'key=([^,; ]*)', 1) END AS log_key,
         CASE WHEN kind = 'retry' THEN
           CASE WHEN msg LIKE '%ms' THEN CAST(round(CAST(regexp_extract(msg, 'retrying in ([0-9.]+)ms$', 1) AS DOUBLE)) AS BIGINT)
                ELSE CAST(round(CAST(regexp_extract(msg, 'retrying in ([0-9.]+)s$', 1) AS DOUBLE) * 1000) AS BIGINT) END
         END AS delay_ms,
         CASE WHEN length(line) >= 19 AND contains(substr(line, 1, 19), '/') THEN substr(line, 12, 8) ELSE 'time N/A' END AS clock,
         line
  FROM (SELECT *, CASE WHEN msg LIKE 'Worker %' THEN 'processing'
                       WHEN regexp_matches(msg, '^Message partition [0-9]+ offset [0-9]+ failed') THEN 'retry'
                       WHEN regexp_matches(msg, '^Message partition [0-9]+ offset [0-9]+ exhausted') THEN 'exhausted'
                       WHEN msg LIKE '✓ Processed%' THEN 'processed'
                       WHEN msg LIKE '✓ Committed%' THEN 'committed' END AS kind
        FROM (SELECT *, substr(line, 21) AS msg FROM loglines)) WHERE kind IS NOT NULL),
replay_keys AS (
  SELECT scenario, log_key AS replay_key FROM (
    SELECT scenario, log_key, row_number() OVER (PARTITION BY scenario ORDER BY ts_ms, kind_rank, "partition", "offset", attempt) AS rn
    FROM parsed WHERE kind = 'retry') WHERE rn = 1),
occ AS (
  SELECT l.scenario, k.replay_key,
         CAST(sum((length(l.line) - length(replace(l.line, 'key=' || k.replay_key, ''))) // length('key=' || k.replay_key)) AS BIGINT) AS occurrences
  FROM loglines l JOIN replay_keys k ON k.scenario = l.scenario GROUP BY 1, 2),
pm AS (
  SELECT p.*, max(log_offset) OVER (PARTITION BY scenario, log_partition ORDER BY ts_ms, kind_rank, "partition", "offset", attempt
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
  FROM parsed p WHERE kind = 'processed'),
fcl AS (
  SELECT scenario, log_partition, min(ts_ms * 8 + kind_rank) AS fcs FROM parsed WHERE kind = 'committed' GROUP BY 1, 2),
ooo AS (
  SELECT pm.scenario,
         bool_or(COALESCE(pm.prev_max > pm.log_offset, false) AND COALESCE(f.fcs > pm.ts_ms * 8 + pm.kind_rank, false)) AS out_of_order,
         count(*) FILTER (WHERE COALESCE(pm.prev_max > pm.log_offset, false) AND COALESCE(f.fcs > pm.ts_ms * 8 + pm.kind_rank, false)) AS late_completions
  FROM pm LEFT JOIN fcl f ON f.scenario = pm.scenario AND f.log_partition = pm.log_partition
  GROUP BY 1)
"""


def q(select: str) -> str:
    return "WITH " + CTES.strip() + "\n" + select.strip()


def queries() -> dict[str, str]:
    return {
        "key_partition": q("""
            SELECT key, "partition", count(*) AS records FROM records GROUP BY 1, 2"""),
        "offset_assign": q("""
            SELECT "partition", "offset", key, value, fetched_ms FROM records"""),
        "baseline_offset": q("""SELECT "partition", base FROM base"""),
        "key_override": q("""
            SELECT key, min(latency_ms) AS min_latency_ms, max(latency_ms) AS max_latency_ms,
                   count(*) AS records
            FROM handled GROUP BY key"""),
        "attempt_outcome": q("""SELECT * FROM outcomes"""),
        "attempt_expand": q("""SELECT * FROM attempts"""),
        "retry_schedule": q("""
            SELECT "partition", "offset", attempt, retry, delay_ms FROM attempts WHERE NOT ok"""),
        "exhausted": q("""SELECT * FROM outcomes WHERE status = 'exhausted'"""),
        "failed_attempt_counter": q("""
            SELECT "partition", "offset", key, attempt, ok,
                   CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (
                        PARTITION BY "partition", key ORDER BY "offset", attempt
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS failures_so_far
            FROM attempts"""),
        "frontier_timeline": q("""SELECT * FROM timeline"""),
        "stream_frontier": q("""SELECT * FROM timeline"""),
        "stream_pipeline": q("""SELECT * FROM timeline"""),
        "frontier_snapshot": q("""SELECT "partition", base, last_committed FROM snap"""),
        "dense_timeline": q(f"""
            , d AS (
              SELECT "partition", "offset", max(COALESCE(done_ms, {INF})) OVER (
                       PARTITION BY "partition" ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
              FROM (SELECT o.* FROM outcomes o JOIN records r ON r."partition" = o."partition" AND r."offset" = o."offset"
                    WHERE COALESCE(r.k % 10 <> 9, true)))
            SELECT "partition", c AS commit_ms, max("offset") AS committed_through, count(*) AS released FROM d WHERE c < {INF} GROUP BY 1, 2"""),
        "dense_snapshot": q(f"""
            , o2 AS (SELECT o.* FROM outcomes o JOIN records r ON r."partition" = o."partition" AND r."offset" = o."offset"
                     WHERE COALESCE(r.k % 10 <> 9, true)),
            d AS (
              SELECT "partition", "offset", max(COALESCE(done_ms, {INF})) OVER (
                       PARTITION BY "partition" ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
              FROM o2),
            s AS (SELECT "partition", CAST(COALESCE(max(CASE WHEN c < {INF} THEN "offset" END), min("offset") - 1) AS BIGINT) AS last_committed FROM d GROUP BY 1)
            SELECT s."partition", s.last_committed, CAST(count(o."offset") FILTER (WHERE o.done_ms IS NULL) AS BIGINT) AS in_flight,
                   CAST(count(o."offset") FILTER (WHERE o.done_ms IS NOT NULL) AS BIGINT) AS completed, CAST(count(o."offset") AS BIGINT) AS pending
            FROM s LEFT JOIN o2 o ON o."partition" = s."partition" AND o."offset" > s.last_committed GROUP BY 1, 2"""),
        "blocked_by_gap": q("""
            SELECT "partition", min("offset") AS blocker_offset, commit_ms,
                   count(*) FILTER (WHERE done_ms IS NOT NULL AND (commit_ms IS NULL OR done_ms < commit_ms)) AS blocked,
                   max(CASE WHEN done_ms IS NOT NULL THEN commit_ms - done_ms END) AS max_blocked_ms,
                   CAST(sum(CASE WHEN done_ms IS NOT NULL THEN commit_ms - done_ms END) AS BIGINT) AS total_blocked_ms
            FROM ctimes GROUP BY "partition", commit_ms
            HAVING count(*) FILTER (WHERE done_ms IS NOT NULL AND (commit_ms IS NULL OR done_ms < commit_ms)) > 0"""),
        "pending_count": q("""
            SELECT s."partition", s.last_committed,
                   CAST(count(o."offset") FILTER (WHERE o.done_ms IS NULL) AS BIGINT) AS in_flight,
                   CAST(count(o."offset") FILTER (WHERE o.done_ms IS NOT NULL) AS BIGINT) AS completed,
                   CAST(count(o."offset") AS BIGINT) AS pending
            FROM snap s LEFT JOIN outcomes o ON o."partition" = s."partition" AND o."offset" > s.last_committed
            GROUP BY 1, 2"""),
        "tracker_snapshot": q("""
            , above AS (
              SELECT o."partition", o."offset", CASE WHEN o.done_ms IS NULL THEN 'in_flight' ELSE 'completed' END AS "set"
              FROM outcomes o JOIN snap s ON o."partition" = s."partition" WHERE o."offset" > s.last_committed)
            SELECT s."partition", s.last_committed,
                   count(a."offset") OVER (PARTITION BY s."partition") AS pending,
                   count(a."offset") FILTER (WHERE a."set" = 'in_flight') OVER (PARTITION BY s."partition") AS in_flight,
                   count(a."offset") FILTER (WHERE a."set" = 'completed') OVER (PARTITION BY s."partition") AS completed,
                   a."set", CASE WHEN a."offset" IS NOT NULL THEN
                     row_number() OVER (PARTITION BY s."partition", a."set" ORDER BY a."offset") END AS rank, a."offset"
            FROM snap s LEFT JOIN above a ON a."partition" = s."partition" """).replace(")\n, above", "),\nabove", 1),
        "final_commit": q("""SELECT * FROM final_commit"""),
        "commit_record_lookup": q("""
            SELECT c."partition", c.committed_through, c.commit_ms, c.ok, r.key, r.value
            FROM commits c JOIN records r ON r."partition" = c."partition" AND r."offset" = c.committed_through"""),
        "unknown_commit": q("""
            , stored AS (
              SELECT * FROM commits
              UNION ALL SELECT "partition", max(committed_through) + 1, max(commit_ms), true FROM commits GROUP BY 1)
            SELECT c.* FROM stored c
            WHERE NOT EXISTS (SELECT 1 FROM records r WHERE r."partition" = c."partition" AND r."offset" = c.committed_through)""").replace(")\n, stored", "),\nstored", 1),
        "untracked_completion": q("""
            SELECT c."partition", c."offset", c.done_ms FROM comps c LEFT JOIN base b ON b."partition" = c."partition"
            WHERE (b.base IS NULL OR c."offset" > b.base)
              AND NOT EXISTS (SELECT 1 FROM records r WHERE r."partition" = c."partition" AND r."offset" = c."offset")"""),
        "completion_class": q("""
            SELECT c."partition", c."offset", c.done_ms,
                   CASE WHEN c."offset" <= b.base THEN 'noop_committed'
                        WHEN t."offset" IS NULL OR c.early THEN 'error_not_in_flight'
                        WHEN c.nth = 1 THEN 'ok'
                        WHEN c.done_ms >= t.commit_ms THEN 'noop_committed'
                        ELSE 'error_double' END AS completion_class
            FROM (SELECT *, row_number() OVER (PARTITION BY "partition", "offset", early ORDER BY done_ms) AS nth
                  FROM (SELECT m.*, COALESCE(m.done_ms < r.fetched_ms, false) AS early
                        FROM comps m LEFT JOIN records r ON r."partition" = m."partition" AND r."offset" = m."offset")) c LEFT JOIN base b ON b."partition" = c."partition"
            LEFT JOIN ctimes t ON t."partition" = c."partition" AND t."offset" = c."offset" """),
        "commit_cache": q("""
            SELECT r."partition", count(*) AS cached,
                   CAST(sum(strlen(r.key) + strlen(r.value)) AS BIGINT) AS cached_bytes,
                   min(r."offset") AS lowest_cached
            FROM records r LEFT JOIN final_commit f ON f."partition" = r."partition"
            WHERE f.committed_through IS NULL OR r."offset" > f.committed_through
            GROUP BY 1"""),
        "redelivery_dedup": q(f"""
            , fetches AS (
              SELECT "partition", "offset", fetched_ms FROM records
              UNION ALL
              SELECT r."partition", r."offset", {RESTART_AT_MS} FROM records r JOIN snap s
                ON s."partition" = r."partition" WHERE r."offset" > s.last_committed)
            SELECT f."partition", f."offset", max(f.fetched_ms) AS fetched_ms, count(*) AS deliveries
            FROM fetches f LEFT JOIN final_commit c ON c."partition" = f."partition"
            WHERE c.committed_through IS NULL OR f."offset" > c.committed_through
            GROUP BY 1, 2""").replace(")\n, fetches", "),\nfetches", 1),
        "drain_split": q("""
            SELECT "partition", split, final_status, count(*) AS records FROM split GROUP BY 1, 2, 3"""),
        "replay_set": q("""SELECT * FROM replay"""),
        "replay_duplicates": q("""
            SELECT r.* FROM replay r WHERE EXISTS (SELECT 1 FROM split s WHERE s."partition" = r."partition"
              AND s."offset" = r."offset" AND s.final_status = 'done')"""),
        "no_loss": q("""
            , per AS (
              SELECT r."partition", r."offset", CAST(count(s."offset") AS BIGINT) AS successes
              FROM records r LEFT JOIN succ s ON s."partition" = r."partition" AND s."offset" = r."offset"
              GROUP BY 1, 2)
            SELECT successes, count(*) AS records FROM per GROUP BY 1"""),
        "lost_records": q("""
            SELECT * EXCLUDE (seq, event_type, k) FROM records r
            WHERE NOT EXISTS (SELECT 1 FROM succ s WHERE s."partition" = r."partition" AND s."offset" = r."offset")"""),
        "replay_timeline": q(f"""
            , c2 AS (
              SELECT "partition", "offset", max(COALESCE(done_ms, {INF})) OVER (PARTITION BY "partition" ORDER BY "offset"
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS commit_ms FROM second)
            SELECT "partition", commit_ms, max("offset") AS committed_through, count(*) AS released
            FROM c2 WHERE commit_ms < {INF} GROUP BY 1, 2"""),
        "resume_scan": q("""
            SELECT r."partition", COALESCE(f.committed_through + 1, min(r."offset")) AS start_offset,
                   max(r."offset") AS last_offset, count(*) AS to_read
            FROM records r LEFT JOIN fc1 f ON f."partition" = r."partition"
            WHERE f.committed_through IS NULL OR r."offset" > f.committed_through
            GROUP BY r."partition", f.committed_through"""),
        "commit_outcome": q("""
            SELECT "partition", max(CASE WHEN ok THEN committed_through END) AS durable_frontier,
                   max(committed_through) AS memory_frontier,
                   count(*) FILTER (WHERE NOT ok) AS failed_commits,
                   (SELECT min(commit_ms) FROM cf WHERE NOT ok) AS first_failure_ms
            FROM cf GROUP BY 1"""),
        "processed_count": q("""
            , dn AS (SELECT "partition", count(*) FILTER (WHERE done_ms IS NOT NULL) AS done FROM cutrun GROUP BY 1),
            fl AS (SELECT "partition", count(*) FILTER (WHERE NOT ok) AS failed FROM cf GROUP BY 1)
            SELECT dn."partition", dn.done, CAST(COALESCE(fl.failed, 0) AS BIGINT) AS failed_commits,
                   CAST(dn.done - COALESCE(fl.failed, 0) AS BIGINT) AS processed
            FROM dn LEFT JOIN fl ON fl."partition" = dn."partition" """),
        "catch_up": q(f"""
            , pd AS (SELECT max(fetched_ms) AS producer_done_ms, count(*) AS produced FROM records),
            waits AS (
              SELECT produced AS expected, producer_done_ms, producer_done_ms + 5000 AS deadline_ms, NULL AS stop FROM pd
              UNION ALL SELECT 500, producer_done_ms, producer_done_ms + 5000, NULL FROM pd
              UNION ALL SELECT 500, producer_done_ms, producer_done_ms, NULL FROM pd
              UNION ALL SELECT produced, producer_done_ms, producer_done_ms + 5000, {T} FROM pd),
            ends AS (
              SELECT *, CASE WHEN stop IS NULL THEN deadline_ms ELSE least(deadline_ms, greatest(stop, producer_done_ms)) END AS ends_ms
              FROM waits),
            nth AS (
              SELECT done_ms, row_number() OVER (ORDER BY done_ms) AS n FROM outcomes WHERE done_ms IS NOT NULL),
            reached AS (
              SELECT w.expected, w.producer_done_ms, w.deadline_ms, w.ends_ms,
                     count(*) FILTER (WHERE nth.done_ms <= w.ends_ms) AS processed_at_deadline,
                     max(CASE WHEN n = w.expected AND nth.done_ms <= w.ends_ms AND w.deadline_ms > w.producer_done_ms
                              THEN nth.done_ms END) AS reached_ms
              FROM ends w, nth GROUP BY 1, 2, 3, 4)
            SELECT CAST(expected AS BIGINT) AS expected, producer_done_ms, deadline_ms,
                   CAST(processed_at_deadline AS BIGINT) AS processed_at_deadline,
                   CASE WHEN reached_ms IS NOT NULL THEN greatest(reached_ms, producer_done_ms) END AS caught_up_ms,
                   CASE WHEN deadline_ms = producer_done_ms THEN 'not_waited' WHEN reached_ms IS NOT NULL THEN 'caught_up'
                        WHEN ends_ms < deadline_ms THEN 'interrupted' ELSE 'timeout' END AS status
            FROM reached"""),
        "active_jobs": q("""
            , jobev AS (
              SELECT fetched_ms AS ts_ms, 1 AS d FROM withfetch UNION ALL SELECT end_ms, -1 FROM withfetch),
            per AS (SELECT ts_ms, CAST(sum(d) AS BIGINT) AS delta FROM jobev GROUP BY 1)
            SELECT ts_ms, delta, CAST(sum(delta) OVER (ORDER BY ts_ms ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                   AS BIGINT) AS active FROM per"""),
        "error_filter": q(f"""
            , da AS (
              SELECT CASE WHEN a.end_ms > {CUT} THEN 'context canceled' ELSE a.error END AS error
              FROM attempts a JOIN records r ON r."partition" = a."partition" AND r."offset" = a."offset"
              WHERE r.fetched_ms < {T} AND a.start_ms < {CUT})
            SELECT error, count(*) AS attempts, (NOT contains(error, 'canceled')) AS is_failure
            FROM da WHERE error IS NOT NULL GROUP BY error"""),
        "log_parse": q("""
            SELECT scenario, ts_ms, kind_rank, "partition", "offset", attempt, kind, log_partition, log_offset,
                   log_attempt, log_key, delay_ms, clock FROM parsed"""),
        "log_keyword_filter": q(f"""
            SELECT * FROM loglines WHERE {" OR ".join(f"contains(line, '{k}')" for k in KEYWORDS)}"""),
        "log_out_of_order": q("""SELECT * FROM ooo"""),
        "log_file_out_of_order": q("""SELECT * FROM ooo"""),
        "substring_count": q("""SELECT * FROM occ"""),
        "scenario_checks": q(f"""
            , seen AS (
              SELECT scenario, {", ".join(f"bool_or(contains(line, '{m}')) AS h{i}" for i, (m, _, _) in enumerate(CHECKS))},
                     bool_or(contains(line, 'replayed messages')) AS replayed
              FROM loglines GROUP BY 1),
            parts AS (
              SELECT s.scenario, concat_ws('; ', {", ".join(f"CASE WHEN h{i} AND {_expected(e)} THEN '{sent}' END" for i, (_, sent, e) in enumerate(CHECKS))},
                     CASE WHEN k.replay_key IS NOT NULL AND (COALESCE(o.occurrences, 0) >= 2 OR replayed) THEN 'uncommitted message replay was observed' END,
                     CASE WHEN COALESCE(x.out_of_order, false) AND {_expected(OUT_OF_ORDER_CHECK)} THEN 'out-of-order completion still committed only after the gap closed' END) AS joined
              FROM seen s LEFT JOIN replay_keys k ON k.scenario = s.scenario
              LEFT JOIN occ o ON o.scenario = s.scenario LEFT JOIN ooo x ON x.scenario = s.scenario)
            SELECT scenario, CASE WHEN joined = '' THEN 'This scenario ran, but none of the expected summary checks were matched.' ELSE joined || '.' END AS summary FROM parts"""),
        "log_first_last": q(f"""
            , kw AS (SELECT unnest([{", ".join("'" + k + "'" for k in KEYWORDS)}]) AS keyword),
            hits AS (
              SELECT l.scenario, k.keyword, arg_min(CASE WHEN length(l.line) >= 19 AND contains(substr(l.line, 1, 19), '/') THEN substr(l.line, 12, 8) ELSE 'time N/A' END, l.ts_ms) AS first_clock,
                     arg_max(CASE WHEN length(l.line) >= 19 AND contains(substr(l.line, 1, 19), '/') THEN substr(l.line, 12, 8) ELSE 'time N/A' END, l.ts_ms) AS last_clock
              FROM loglines l JOIN kw k ON contains(l.line, k.keyword) GROUP BY 1, 2),
            every AS (SELECT s.scenario, k.keyword FROM (SELECT DISTINCT scenario FROM loglines) s CROSS JOIN kw k)
            SELECT e.scenario, e.keyword, COALESCE(h.first_clock, 'time N/A') AS first_clock,
                   COALESCE(h.last_clock, 'time N/A') AS last_clock
            FROM every e LEFT JOIN hits h ON h.scenario = e.scenario AND h.keyword = e.keyword"""),
        "user_handler": q(f"""
            , h AS (
              SELECT "partition", "offset", key, fetched_ms, seq % 101 = 5 AS raises, seq % 7 = 3 AS flaky, 10 * (seq % 10) AS took, seq,
                     unnest(range(1, CASE WHEN seq % 101 = 5 THEN {N} + 2 WHEN seq % 7 = 3 THEN 3 ELSE 2 END)) AS a
              FROM records),
            t AS (SELECT *, fetched_ms + (a - 1) * took + {SUMS}[a] AS start_ms, NOT raises AND NOT (flaky AND a = 1) AS ok FROM h)
            SELECT "partition", "offset", key, CAST(a AS INTEGER) AS attempt, CAST(start_ms AS BIGINT) AS start_ms,
                   CAST(start_ms + took AS BIGINT) AS end_ms, ok,
                   CASE WHEN ok THEN NULL WHEN raises THEN 'HandlerFault: cannot read message ' || CAST(seq AS VARCHAR) ELSE 'not yet' END AS error,
                   NOT ok AND a <= {N} AS retry, CAST(CASE WHEN NOT ok AND a <= {N} THEN {DELAY_LIST}[a] ELSE 0 END AS BIGINT) AS delay_ms
            FROM t"""),
        "key_failure_budget": q(f"""
            , ranked AS (
              SELECT "partition", "offset", key,
                     row_number() OVER (PARTITION BY "partition", key ORDER BY "offset") - 1 AS j
              FROM records),
            budgeted AS (
              SELECT "partition", "offset", key,
                     CAST(CASE WHEN CAST(substr(key, 5) AS BIGINT) % 10 = 2
                               THEN greatest(0, least({N} + 1, 5 - j * ({N} + 1))) ELSE 0 END AS INTEGER) AS failures
              FROM ranked)
            SELECT "partition", "offset", key, failures, CAST(least(failures, {N}) + 1 AS INTEGER) AS attempts,
                   CASE WHEN failures <= {N} THEN 'done' ELSE 'exhausted' END AS status
            FROM budgeted"""),
        "turn_keyword_filter": """
            SELECT * FROM conversations
            WHERE contains(text, 'the') OR contains(text, 'und') OR contains(text, 'quiero') OR contains(text, chr(10))""",
        "language_word_count": """
            SELECT d.lang, w.replay_key,
                   CAST(COALESCE(sum((length(text) - length(replace(text, w.replay_key, ''))) // length(w.replay_key)), 0) AS BIGINT)
                     AS occurrences
            FROM documents d JOIN (VALUES ('de', 'und'), ('en', 'the'), ('es', 'que'), ('fr', 'le')) w(lang, replay_key)
              ON w.lang = d.lang GROUP BY 1, 2""",
        "lineitem_pending": f"""
            WITH li AS (
              SELECT l_orderkey * 16 + l_linenumber AS seq, 'order-' || CAST(l_orderkey AS VARCHAR) AS key,
                     CAST(epoch_us(l_shipdate) // 1000 AS BIGINT) AS fetched_ms,
                     CAST(CASE WHEN l_returnflag = 'R' THEN l_linenumber % 5 ELSE 0 END AS INTEGER) AS failures,
                     CAST(round(l_quantity * 100) AS BIGINT) AS latency_ms
              FROM lineitem),
            hashed AS (
              SELECT *, list_reduce([CAST(2166136261 AS BIGINT)] || list_transform(range(1, length(key) + 1),
                          lambda i: CAST(ascii(substr(key, CAST(i AS INTEGER), 1)) AS BIGINT)),
                        lambda h, b: (xor(h, b) * 16777619) % 4294967296) AS h
              FROM li),
            recs AS (
              SELECT CAST(abs((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {P}) AS INTEGER) AS "partition",
                     seq, fetched_ms, failures, latency_ms FROM hashed),
            rec2 AS (
              SELECT *, row_number() OVER (PARTITION BY "partition"
                                           ORDER BY seq, fetched_ms, failures, latency_ms) - 1 AS "offset" FROM recs),
            outc AS (
              SELECT "partition", "offset",
                     CASE WHEN failures <= {N} THEN fetched_ms + (least(failures, {N}) + 1) * latency_ms
                          + {SUMS}[least(failures, {N}) + 1] END AS done_ms
              FROM rec2),
            ct AS (
              SELECT "partition", "offset", done_ms,
                     max(CASE WHEN done_ms IS NULL THEN {INF} ELSE done_ms END) OVER (
                       PARTITION BY "partition" ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
              FROM outc),
            snapl AS (
              SELECT "partition", CAST(COALESCE(max(CASE WHEN c < {INF} THEN "offset" END), min("offset") - 1) AS BIGINT)
                     AS last_committed
              FROM ct GROUP BY 1)
            SELECT s."partition", s.last_committed,
                   CAST(count(o."offset") FILTER (WHERE o.done_ms IS NULL) AS BIGINT) AS in_flight,
                   CAST(count(o."offset") FILTER (WHERE o.done_ms IS NOT NULL) AS BIGINT) AS completed,
                   CAST(count(o."offset") AS BIGINT) AS pending
            FROM snapl s LEFT JOIN outc o ON o."partition" = s."partition" AND o."offset" > s.last_committed
            GROUP BY 1, 2""",
    }
