"""The queries of ``lasting`` as DuckDB SQL: how data arrived or is kept must not change results."""

from __future__ import annotations

from pairloom.constants import SHARD_ASSISTANT_FORMAT, SHARD_LENGTH, SHARD_USER_FORMAT
from pairloom.operators import permutation as P
from pairloom.plans import lasting as L
from pairloom.plans import queries as Q
from pairloom.plans.oracles import ORACLES as PLAIN
from pairloom.plans.oracles import (
    BATCH_TEXT, DOCUMENT_SAMPLES, NUMBERED_DOCUMENTS, SFT_LENGTH, SFT_LINES, SHARD_IDS, STEPS, concat, constant, dealt, text, utf8, window_of,
)
from pairloom.sources import shards as S

def permutation_sql(source: str, key: str) -> str:
    """``key, idx, n_rows`` of a numbered source, permuted by the same integer arithmetic in one CTE a round."""
    def walk() -> str:
        pair = "place // b AS l, place % b AS r"
        for i, k in enumerate(P.round_keys(Q.SEED)):
            half, other, size = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
            x = f"(({other} % {P.PRIME} + {k}) % {P.PRIME})"
            moved = f"({half} + (({x} * {x} + {k}) % {P.PRIME} * {P.FACTOR} + {x}) % {P.PRIME}) % {size} AS {half}"
            inner = f"SELECT {key}, n_rows, a, b, {pair} FROM walk WHERE place >= n_rows OR step = 0" if i == 0 else f"SELECT * FROM ({inner})"
            inner = f"SELECT {key}, n_rows, a, b, {moved}, {other} FROM ({inner})"
        return f"SELECT {key}, 1 AS step, n_rows, a, b, l * b + r AS place FROM ({inner})"

    return f"""sided AS (
  SELECT {key}, idx, n_rows, a, greatest(1, (n_rows + a - 1) // a) AS b
  FROM (SELECT *, greatest(1, floor(sqrt(greatest(n_rows - 1, 0)))::BIGINT + 1) AS a FROM {source})
),
walk AS (
  SELECT {key}, 0 AS step, n_rows, a, b, idx AS place FROM sided
  UNION ALL {walk()}
),
permuted AS (SELECT {key}, n_rows, place AS idx FROM walk WHERE step > 0 AND place < n_rows)"""


def _slices() -> str:
    def cut(split: str, lo: str, hi: str, part: int) -> str:
        return f"""SELECT split, {part} AS part, place - ({lo}) AS place, ({hi}) - ({lo}) AS size, doc_id, text
FROM splits WHERE split = '{split}' AND place >= {lo} AND place < {hi}"""

    parts = (
        cut("train", "0", "round_even(n * 0.5::DOUBLE, 0)::BIGINT", 0), cut("validation", "greatest(n - round_even(n * 0.1::DOUBLE, 0)::BIGINT, 0)", "n", 1),
        cut("train", "least(10, n)", "least(20, n)", 2), cut("validation", "0", "n", 3),
    )
    return f"""WITH splits AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY split) AS n
  FROM (SELECT *, CASE WHEN lang = 'es' THEN 'validation' ELSE 'train' END AS split FROM documents)
),
parts AS ({" UNION ALL ".join(parts)}),
sizes AS (SELECT part, any_value(size) AS size FROM parts GROUP BY part)
SELECT split, place + coalesce((SELECT sum(size) FROM sizes s WHERE s.part < p.part), 0)::BIGINT AS idx,
       (SELECT sum(size)::BIGINT FROM sizes) AS n_rows, doc_id, text
FROM parts p"""


ORACLES: dict[str, str] = {
    "stream_log_tail": f"""WITH {STEPS},
windows AS (
  SELECT rank, max(step) AS step, sum(loss / {Q.ACCUMULATION}) AS loss
  FROM steps GROUP BY rank, {window_of()} HAVING max(step) = {window_of('max(step)')} * {Q.ACCUMULATION}
)
SELECT 'rank' || rank AS run_id, step, 'train' AS kind, printf('%.6f', loss)::DOUBLE AS loss
FROM windows WHERE step > 0 AND step % {Q.SFT_LOG_EVERY} = 0""",
    "stream_closed_windows": PLAIN["accum_loss"],
    "stream_batches": f"""WITH {DOCUMENT_SAMPLES.replace("ORDER BY doc_id", f"ORDER BY doc_id % {L.ROUNDS}, doc_id")}, {dealt()}, {SFT_LENGTH}
SELECT rank, batch_id, row_in_batch, {BATCH_TEXT} FROM batches""",
    "split_expression": _slices(),
    "index_append": f"""SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id % {L.ROUNDS}, doc_id) - 1 AS idx, count(*) OVER () AS n_rows
FROM documents""",
    "permuted_batches": f"""WITH RECURSIVE {NUMBERED_DOCUMENTS}, {permutation_sql("numbered", "doc_id")}, {dealt("permuted")}
SELECT doc_id, idx, rank, batch_id, row_in_batch FROM dealt""",
    "report_bucketed": PLAIN["dpo_report"],
    "log_in_order": f"""WITH {SFT_LINES}
SELECT 'run 5%' AS run_id, row_number() OVER (ORDER BY step, kind) - 1 AS idx, value FROM lines""",
    "prepare_checked": f"""WITH texts AS (
  SELECT doc_id, nullif(source, 'src3') AS query, CASE WHEN lang <> 'es' THEN text END AS response FROM documents
),
ids AS (
  SELECT *, {concat(constant(SHARD_USER_FORMAT), utf8("' ' || query || ' '"), constant(SHARD_ASSISTANT_FORMAT),
                    utf8("' ' || response"))} AS list, query IS NOT NULL AND response IS NOT NULL AS whole
  FROM texts
),
judged AS (
  SELECT doc_id, list, query IS NULL AS a, response IS NULL AS b,
         whole AND list_max(list) >= {L.CHECKED_IDS} AS c, whole AND len(list) > {L.CHECKED_LENGTH} AS d
  FROM ids
)
SELECT 'kept' AS kind, doc_id, {text('list')} AS detail, NULL::BIGINT AS n FROM judged WHERE NOT (a OR b OR c OR d)
UNION ALL
SELECT 'refused', doc_id, concat_ws(', ', CASE WHEN a THEN 'null query' END, CASE WHEN b THEN 'null response' END,
       CASE WHEN c THEN 'id out of range' END, CASE WHEN d THEN 'too long' END), NULL
FROM judged WHERE a OR b OR c OR d
UNION ALL SELECT 'count', NULL, 'rows', count(*) FROM judged
UNION ALL SELECT 'count', NULL, 'refused', count(*) FROM judged WHERE a OR b OR c OR d
UNION ALL SELECT 'count', NULL, 'null query', count(*) FROM judged WHERE a
UNION ALL SELECT 'count', NULL, 'null response', count(*) FROM judged WHERE b
UNION ALL SELECT 'count', NULL, 'id out of range', count(*) FROM judged WHERE c
UNION ALL SELECT 'count', NULL, 'too long', count(*) FROM judged WHERE d""",
    "shard_verify": f"""WITH {SHARD_IDS},
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM shard_tokens),
placed AS (
  SELECT idx // {Q.SHARD} AS shard_id, (idx % {Q.SHARD})::BIGINT AS place, least(len(ids), {SHARD_LENGTH})::BIGINT AS length, tokens FROM numbered
),
summed AS (
  SELECT shard_id, list_reduce(list_concat([(place * 31 + length) % {S.CHECK_PRIME}], tokens::BIGINT[]),
                               lambda s, t: (s * {S.CHECK_FACTOR} + t) % {S.CHECK_PRIME}) AS checksum
  FROM placed
)
SELECT split, shard_id::INTEGER AS shard_id, count(*) AS rows, sum(checksum)::BIGINT AS checksum, 'ok' AS state,
       CASE WHEN split = 'validation' THEN 1 END::BIGINT AS files_if_one
FROM summed, (VALUES ('train'), ('validation')) s(split)
WHERE split = 'train' OR shard_id % 2 = 0 GROUP BY split, shard_id""",
}
