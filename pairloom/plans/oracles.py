"""The queries again as DuckDB SQL over the same tables."""

from __future__ import annotations

from pairloom.constants import (
    BATCH_LENGTH,
    BETA,
    DPO_ANSWER_KEY,
    DPO_PROMPT_KEY,
    END_OF_PROMPT_ID,
    END_OF_TEXT_ID,
    ID_LIMIT,
    IGNORED_LABEL,
    SFT_ANSWER_KEY,
    SFT_PROMPT_KEY,
    SHARD_ASSISTANT_FORMAT,
    SHARD_LENGTH,
    SHARD_ROWS,
    SHARD_USER_FORMAT,
)
from pairloom.functions.encoding import PIECE_PATTERN, SPECIAL_TOKENS
from pairloom.plans import queries as Q
from pairloom.sources.logs import DPO_HEADER, DPO_REPORT_COLUMNS


def quoted(text: str) -> str:
    parts = ["'" + part.replace("'", "''") + "'" for part in text.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


def utf8(text: str) -> str:
    """SQL list of the UTF-8 bytes of a SQL text."""
    return (
        f"list_transform(regexp_extract_all(hex(encode({text})), '..'),"
        " lambda h: ('0x' || h)::INTEGER)"
    )


def constant(text: str) -> str:
    return str(list(text.encode())) + "::INTEGER[]"


def concat(*lists: str) -> str:
    out = lists[0]
    for other in lists[1:]:
        out = f"list_concat({out}, {other})"
    return out


def repeated(value: int, count: str) -> str:
    return f"list_transform(range({count}), lambda i: {value}::INTEGER)"


def resized(ids: str, length: str, fill: int) -> str:
    return f"list_resize({ids}, {length}, {fill}::INTEGER)"


def mask(n: str, length: str) -> str:
    return f"list_transform(range({length}), lambda i: CASE WHEN i < {n} THEN 1 ELSE 0 END)"


def text(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


SFT = f"""
sft AS (
  SELECT conv_id, turn, text AS prompt, next_text AS answer
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant'
)"""

SFT_SAMPLES = f"""{SFT},
sft_ids AS (
  SELECT *, {concat(constant(SFT_PROMPT_KEY), utf8('prompt'), constant(SFT_ANSWER_KEY))} AS pre,
         {utf8('answer')} AS ans
  FROM sft
),
samples AS (
  SELECT conv_id, turn, list_concat(pre, ans) AS input_ids,
         list_concat({repeated(IGNORED_LABEL, 'len(pre)')}, ans) AS label_ids,
         row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, count(*) OVER () AS n_rows
  FROM sft_ids
)"""

DOCUMENT_SAMPLES = f"""
doc_ids AS (
  SELECT doc_id, {concat(constant(SFT_PROMPT_KEY), utf8('source'), constant(SFT_ANSWER_KEY))} AS pre,
         {utf8('text')} AS ans
  FROM documents
),
samples AS (
  SELECT doc_id, list_concat(pre, ans) AS input_ids,
         list_concat({repeated(IGNORED_LABEL, 'len(pre)')}, ans) AS label_ids,
         row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS n_rows
  FROM doc_ids
)"""

PAIRS = f"""{SFT},
pref AS (
  SELECT * FROM (
    SELECT conv_id, turn, prompt, answer AS chosen,
           lead(answer) OVER (PARTITION BY conv_id ORDER BY turn) AS rejected
    FROM sft)
  WHERE rejected IS NOT NULL
)"""

PAIR_SAMPLES = f"""{PAIRS},
pref_ids AS (
  SELECT conv_id, turn,
         {concat(constant(DPO_PROMPT_KEY), utf8('prompt'), constant(DPO_ANSWER_KEY))} AS pre,
         {utf8('chosen')} AS c, {utf8('rejected')} AS r
  FROM pref
),
samples AS (
  SELECT conv_id, turn, list_concat(pre, c) AS chosen_ids, list_concat(pre, r) AS rejected_ids,
         list_concat({repeated(IGNORED_LABEL, 'len(pre)')}, c) AS labels_chosen,
         list_concat({repeated(IGNORED_LABEL, 'len(pre)')}, r) AS labels_rejected,
         row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, count(*) OVER () AS n_rows
  FROM pref_ids
)"""


def dealt(source: str = "samples", ranks: int = Q.RANKS, batch: int = Q.BATCH) -> str:
    return f"""
dealt AS (
  SELECT *, (idx % {ranks})::INTEGER AS rank, idx // {ranks} // {batch} AS batch_id,
         (idx // {ranks} % {batch})::INTEGER AS row_in_batch,
         (n_rows // {ranks} + {batch - 1}) // {batch} AS rank_steps
  FROM {source} WHERE idx < n_rows // {ranks} * {ranks}
)"""


SFT_LENGTH = f"""
sized AS (
  SELECT *, least({BATCH_LENGTH}, max(len(input_ids)) OVER (PARTITION BY rank, batch_id)) AS bl
  FROM dealt
),
batches AS (
  SELECT rank, batch_id, row_in_batch, {resized('input_ids', 'bl', END_OF_TEXT_ID)} AS x,
         {mask('len(input_ids)', 'bl')} AS mask, {resized('label_ids', 'bl', IGNORED_LABEL)} AS y
  FROM sized
)"""

PAIR_LENGTH = f"""
sized AS (
  SELECT *, least({BATCH_LENGTH}, min(greatest(len(chosen_ids), len(rejected_ids)))
                  OVER (PARTITION BY rank, batch_id)) AS bl,
         least({BATCH_LENGTH}, max(greatest(len(chosen_ids), len(rejected_ids)))
                  OVER (PARTITION BY rank, batch_id)) AS longest
  FROM dealt
),
sides AS (
  SELECT rank, batch_id, rank_steps, row_in_batch AS pair_in_batch, bl,
         2 * row_in_batch AS row_in_batch, 'chosen' AS side, chosen_ids AS ids, labels_chosen AS labels
  FROM sized
  UNION ALL
  SELECT rank, batch_id, rank_steps, row_in_batch, bl, 2 * row_in_batch + 1, 'rejected',
         rejected_ids, labels_rejected
  FROM sized
),
batches AS (
  SELECT rank, batch_id, rank_steps, pair_in_batch, row_in_batch, side,
         {resized('ids', 'bl', END_OF_TEXT_ID)} AS x, {mask('len(ids)', 'bl')} AS mask,
         {resized('labels', 'bl', IGNORED_LABEL)} AS y
  FROM sides
)"""

SFT_BATCHES = f"WITH {SFT_SAMPLES}, {dealt()}, {SFT_LENGTH}"


def pair_batches(source: str = "samples", ranks: int = Q.RANKS) -> str:
    return f"WITH {PAIR_SAMPLES}, {_HELD_OUT} {dealt(source, ranks)}, {PAIR_LENGTH}"


_HELD_OUT = """
held_out AS (
  SELECT * REPLACE (idx - lo AS idx, n_rows - lo AS n_rows)
  FROM (SELECT *, round_even(n_rows * 0.9::DOUBLE, 0)::BIGINT AS lo FROM samples)
  WHERE idx >= lo
),"""

LOOKED_UP = f"CASE WHEN label = {IGNORED_LABEL} THEN 0 ELSE label END"
TOKENS = f"""
labelled AS (
  SELECT * EXCLUDE (x, mask, y), unnest(y) AS label, unnest(range(len(y))) AS pos FROM batches
),
tokens AS (
  SELECT *, -((({LOOKED_UP}) * 31 + pos) % 97) / 16.0::DOUBLE AS policy,
         -((({LOOKED_UP}) * 17 + pos * 3) % 89) / 16.0::DOUBLE AS reference
  FROM labelled WHERE pos > 0
)"""
COUNTS = f"FILTER (WHERE label <> {IGNORED_LABEL})"


def pair_tokens(source: str = "samples", ranks: int = Q.RANKS) -> str:
    return f"{pair_batches(source, ranks)}, {TOKENS}"


def pair_scores(source: str = "samples", ranks: int = Q.RANKS) -> str:
    def of(side: str, model: str) -> str:
        return (
            f"coalesce(sum({model}) FILTER (WHERE side = '{side}' AND label <> {IGNORED_LABEL}), 0)"
            f" AS {model}_{side}"
        )

    return f"""{pair_tokens(source, ranks)},
pairs AS (
  SELECT rank, batch_id, rank_steps, pair_in_batch, {of('chosen', 'policy')},
         {of('rejected', 'policy')}, {of('chosen', 'reference')}, {of('rejected', 'reference')},
         count(*) FILTER (WHERE side = 'chosen' AND label <> {IGNORED_LABEL}) AS chosen_tokens
  FROM tokens GROUP BY ALL
),
z AS (
  SELECT *, (policy_chosen - policy_rejected) - (reference_chosen - reference_rejected) AS z,
         {BETA}::DOUBLE * (policy_chosen - reference_chosen) AS chosen_reward,
         {BETA}::DOUBLE * (policy_rejected - reference_rejected) AS rejected_reward
  FROM pairs
)"""


def nls(x: str) -> str:
    return f"(greatest(-({x}), 0) + ln(1 + exp(-abs({x}))))"


SIGMOID = nls(f"{BETA}::DOUBLE * z")
REPORT_FIGURES = f"""
         count(*) AS pairs, round(avg({SIGMOID}), 8) AS loss,
         round(avg((chosen_reward > rejected_reward)::INTEGER::DOUBLE), 8) AS reward_accuracy,
         round(avg(chosen_reward), 8) AS chosen_reward,
         round(avg(rejected_reward), 8) AS rejected_reward,
         round(avg(policy_chosen), 8) AS logp_chosen, round(avg(policy_rejected), 8) AS logp_rejected,
         round(avg(reference_chosen), 8) AS logp_chosen_ref,
         round(avg(reference_rejected), 8) AS logp_rejected_ref,
         round(abs(avg(policy_chosen)) - abs(avg(policy_rejected)), 8) AS margin,
         round(abs(avg(reference_chosen)) - abs(avg(reference_rejected)), 8) AS margin_ref,
         round(-sum(policy_chosen) / nullif(sum(chosen_tokens), 0), 8) AS nll_loss"""


def report() -> str:
    lr = (
        f"round({Q.BASE_LR}::DOUBLE * (0.1::DOUBLE + (1 - 0.1::DOUBLE) *"
        " (least(batch_id, rank_steps) / rank_steps::DOUBLE)), 9)"
    )
    return f"""{pair_scores()},
report AS (
  SELECT rank, batch_id, {REPORT_FIGURES}, {lr} AS lr
  FROM z GROUP BY rank, batch_id, rank_steps
)"""


def pair_loss(expression: str) -> str:
    return (
        f"{pair_scores()} SELECT rank, batch_id, pair_in_batch, round({expression}, 8) AS loss FROM z"
    )


STEPS = """
steps AS (
  SELECT (event_id % 4)::INTEGER AS rank, event_id // 4 AS step, (event_id * 7 % 64) / 16.0::DOUBLE AS loss,
         (1 + event_id % 7) / 8.0::DOUBLE AS dt, 256 + event_id * 5 % 769 AS tokens
  FROM events
),
total AS (SELECT count(*) // 4 AS t, count(*) // 4 // 10 AS w FROM events)"""


def linear(step: str) -> str:
    return (
        f"round({Q.BASE_LR}::DOUBLE * CASE WHEN {step} < w THEN {step} / greatest(1, w)::DOUBLE"
        f" ELSE greatest(0, 1 - ({step} - w) / greatest(1, t - w)::DOUBLE) END, 9)"
    )


def window_of(step: str = "step", accumulation: int = Q.ACCUMULATION) -> str:
    return f"greatest(({step} + {accumulation - 1}) // {accumulation}, 1)"


MEAN_STEPS = f"""{STEPS},
mean_steps AS (SELECT step, avg(loss) AS loss FROM steps GROUP BY step),
mean_windows AS (
  SELECT {window_of()} AS window_id, max(step) AS step, count(*) AS steps,
         sum(loss / {Q.ACCUMULATION}) AS loss
  FROM mean_steps GROUP BY 1 HAVING max(step) = {window_of('max(step)')} * {Q.ACCUMULATION}
)"""

SFT_LINES = f"""{MEAN_STEPS},
lines AS (
  SELECT step, 'train' AS kind, printf('%d train %.6f', step, loss) AS value
  FROM mean_windows WHERE step > 0 AND step % {Q.SFT_LOG_EVERY} = 0
  UNION ALL
  SELECT step, 'val', printf('%d val %.4f', step, loss)
  FROM mean_steps WHERE step > 0 AND step % {Q.EVAL_EVERY} = 0
)"""


def dpo_lines() -> str:
    figures = [
        "step::VARCHAR" if c == "step" else f"coalesce({c}::VARCHAR, 'nan')" for c in DPO_REPORT_COLUMNS
    ]
    line = " || '; ' || ".join(figures)
    return f"""{report()}, {STEPS},
logged AS (
  SELECT r.*, r.batch_id AS step, round({float(Q.BATCH * Q.ACCUMULATION)}::DOUBLE / s.dt, 8) AS row_per_s
  FROM report r JOIN steps s ON s.rank = r.rank AND s.step = r.batch_id
  WHERE r.batch_id > 0 AND r.batch_id % {Q.LOG_EVERY} = 0
),
lines AS (
  SELECT rank, step, CASE WHEN step = {Q.LOG_EVERY} THEN 1 ELSE 0 END AS line_in_step,
         {line} AS value
  FROM logged
  UNION ALL
  SELECT rank, step, 0, {quoted(DPO_HEADER)} FROM logged WHERE step = {Q.LOG_EVERY}
)"""


VOCABULARY = f"""
pieces AS (
  SELECT doc_id, unnest(ps) AS piece, unnest(range(len(ps))) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, {quoted(PIECE_PATTERN)}) AS ps FROM documents)
),
counted AS (
  SELECT piece, count(*) AS n FROM pieces WHERE octet_length(encode(piece)) > 1 GROUP BY piece
),
words AS (
  SELECT piece, (row_number() OVER (ORDER BY n DESC, piece) + 255)::INTEGER AS token_id
  FROM counted QUALIFY token_id < {END_OF_TEXT_ID}
)"""

WORD_IDS = f"""{VOCABULARY},
piece_ids AS (
  SELECT doc_id, pos, CASE WHEN token_id IS NULL THEN {utf8('piece')} ELSE [token_id] END AS ids
  FROM pieces LEFT JOIN words USING (piece)
),
encoded AS (
  SELECT d.doc_id, coalesce(e.ids, []::INTEGER[]) AS ids
  FROM documents d LEFT JOIN (
    SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids FROM piece_ids GROUP BY doc_id
  ) e USING (doc_id)
)"""

SHARD_IDS = f"""
shard_ids AS (
  SELECT doc_id, {concat(constant(SHARD_USER_FORMAT), utf8("' ' || source || ' '"),
                         constant(SHARD_ASSISTANT_FORMAT), utf8("' ' || text"))} AS ids
  FROM documents
),
shard_tokens AS (
  SELECT *, CASE WHEN len(ids) > {SHARD_LENGTH}
                 THEN list_append(ids[:{SHARD_LENGTH - 1}], {END_OF_PROMPT_ID}::INTEGER)
                 ELSE {resized('ids', str(SHARD_LENGTH), END_OF_PROMPT_ID)} END AS tokens
  FROM shard_ids
)"""

SOFTMAX = """
top AS (SELECT *, list_max(embedding)::DOUBLE AS m FROM embeddings),
logits AS (
  SELECT vec_id, label, m, unnest(embedding)::DOUBLE AS e, unnest(range(len(embedding)))::INTEGER AS token_id
  FROM top
),
sums AS (SELECT vec_id, sum(exp(e - m)) AS s FROM logits GROUP BY vec_id),
probs AS (
  SELECT vec_id, token_id, exp(e - m) / s AS p FROM logits JOIN sums USING (vec_id)
)"""
TOP = f"""{SOFTMAX},
best AS (
  SELECT *, (row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, token_id) - 1)::INTEGER AS place
  FROM probs QUALIFY place < {Q.TOP_K}
)"""

SHUFFLED = f"""
shuffled AS (
  SELECT conv_id, turn, count(*) OVER () AS n_rows,
         row_number() OVER (ORDER BY md5('{Q.SEED}:' || conv_id || ':' || turn), conv_id, turn) - 1 AS idx
  FROM conversations
)"""

BATCH_TEXT = f"{text('x')} AS x, {text('mask')} AS mask, {text('y')} AS y"
MOVED_SCORES = f"""WITH {SFT_SAMPLES},
scored AS (
  SELECT conv_id, turn, unnest(range(len(input_ids) - 1))::INTEGER AS pos,
         unnest(input_ids[:-2]) AS id, unnest(label_ids[2:]) AS label
  FROM samples
)
SELECT conv_id, turn, pos, -((id * 31 + pos) % 97) / 16.0::DOUBLE AS score, label FROM scored"""
NUMBERED_DOCUMENTS = """
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS n_rows FROM documents
)"""

LABEL_LOGP = f"""WITH {SOFTMAX}
SELECT vec_id, round(e - m - ln(s), 8) AS logp FROM logits JOIN sums USING (vec_id)
WHERE token_id = label"""

ORACLES: dict[str, str] = {
    "scan_split": "SELECT doc_id, lang, source, text FROM documents WHERE lang = 'en'",
    "split_slice": f"""WITH {NUMBERED_DOCUMENTS}
SELECT doc_id, idx, text FROM numbered WHERE idx < round_even(n_rows * 0.5::DOUBLE, 0)""",
    "column_mapping": "SELECT doc_id, source AS prompt, text AS answer FROM documents",
    "vocab_table": f"""WITH {VOCABULARY}
SELECT hex(encode(piece)) AS token_hex, token_id, 0 AS is_special FROM words
UNION ALL SELECT printf('%02X', b), b::INTEGER, 0 FROM range(256) r(b)
""" + "".join(
        f"UNION ALL SELECT hex(encode('{token}')), {i}, 1\n" for token, i in SPECIAL_TOKENS.items()
    ),
    "shard_assign": f"""WITH {NUMBERED_DOCUMENTS}
SELECT doc_id, (idx // {Q.SHARD})::INTEGER AS shard_id, (idx % {Q.SHARD})::INTEGER AS row_in_shard,
       (idx // least({SHARD_ROWS}, n_rows))::INTEGER AS default_shard,
       (idx % least({SHARD_ROWS}, n_rows))::INTEGER AS default_row,
       printf('documents_train_%06d', idx // {Q.SHARD}) AS shard
FROM numbered""",
    "shard_sink": f"""WITH {SHARD_IDS},
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM shard_tokens)
SELECT split, printf('documents_%s_%06d', split, idx // {Q.SHARD}) AS shard, (idx // {Q.SHARD})::INTEGER AS shard_id,
       (idx % {Q.SHARD})::INTEGER AS row_in_shard, {text('tokens')} AS tokens,
       least(len(ids), {SHARD_LENGTH})::INTEGER AS length
FROM numbered, (VALUES ('train'), ('validation')) s(split)
WHERE split = 'train' OR (idx // {Q.SHARD}) % 2 = 0""",
    "template_sft": f"""WITH {SFT} SELECT conv_id, turn,
{quoted(SFT_PROMPT_KEY)} || prompt || {quoted(SFT_ANSWER_KEY)} || answer AS text FROM sft""",
    "template_dpo": f"""WITH {PAIRS} SELECT conv_id, turn,
{quoted(DPO_PROMPT_KEY)} || prompt || {quoted(DPO_ANSWER_KEY)} || chosen AS chosen,
{quoted(DPO_PROMPT_KEY)} || prompt || {quoted(DPO_ANSWER_KEY)} || rejected AS rejected FROM pref""",
    "template_shard": f"""SELECT doc_id, {quoted(SHARD_USER_FORMAT)} || ' ' || source || ' ' ||
{quoted(SHARD_ASSISTANT_FORMAT)} || ' ' || text AS text FROM documents""",
    "encode_bytes": f"""SELECT doc_id, len(ids)::INTEGER AS n_ids, {text('ids')} AS ids
FROM (SELECT doc_id, {utf8('text')} AS ids FROM documents)""",
    "encode_vocab": f"""WITH {WORD_IDS}
SELECT doc_id, len(ids)::INTEGER AS n_ids, {text('ids')} AS ids FROM encoded""",
    "vocab_join": f"""WITH {VOCABULARY}
SELECT doc_id, token_id, count(*) AS n FROM pieces LEFT JOIN words USING (piece) GROUP BY ALL""",
    "decode_bpe": "SELECT doc_id, text FROM documents",
    "decode_ids": "SELECT doc_id, text FROM documents",
    "label_mask": f"""WITH {SFT_SAMPLES}
SELECT conv_id, turn, {text('input_ids')} AS input_ids, {text('label_ids')} AS label_ids FROM samples""",
    "dpo_samples": f"""WITH {PAIR_SAMPLES}
SELECT conv_id, turn, {text('chosen_ids')} AS chosen_ids, {text('labels_chosen')} AS labels_chosen,
       {text('rejected_ids')} AS rejected_ids, {text('labels_rejected')} AS labels_rejected
FROM samples""",
    "attention_mask": f"""WITH {SFT_SAMPLES}
SELECT conv_id, turn, len(input_ids)::INTEGER AS n_ids, {text(repeated(1, 'len(input_ids)'))} AS mask,
       {text(f'''list_transform(range(greatest({BATCH_LENGTH}, 0)),
       lambda i: CASE WHEN i < len(input_ids) THEN 1 ELSE 0 END)''')} AS padded_mask
FROM samples""",
    "pad_truncate": f"""WITH {DOCUMENT_SAMPLES}
SELECT doc_id, {text(resized('input_ids', str(BATCH_LENGTH), END_OF_TEXT_ID))} AS x,
       {text(mask('len(input_ids)', str(BATCH_LENGTH)))} AS mask,
       {text(resized('label_ids', str(BATCH_LENGTH), IGNORED_LABEL))} AS y
FROM samples""",
    "pad_eot": f"WITH {SHARD_IDS} SELECT doc_id, {text('tokens')} AS tokens FROM shard_tokens",
    "check_range": f"""WITH {WORD_IDS}
SELECT doc_id, len(list_filter(ids, lambda i: i < 0 OR i >= 256))::INTEGER AS n_beyond_bytes,
       len(ids)::INTEGER AS n_ids,
       len(list_filter(ids, lambda i: i < 0 OR i >= {ID_LIMIT}))::INTEGER AS n_out_of_range
FROM encoded""",
    "check_length": f"""WITH {SHARD_IDS}
SELECT doc_id, 'ids' AS checked, len(ids)::INTEGER AS n FROM shard_tokens WHERE len(ids) <> {SHARD_LENGTH}
UNION ALL
SELECT doc_id, 'tokens', len(tokens)::INTEGER FROM shard_tokens WHERE len(tokens) <> {SHARD_LENGTH}""",
    "prompt_only": f"""WITH {SFT}
SELECT conv_id, turn, copy::INTEGER AS copy, {text(
        concat(constant(SFT_PROMPT_KEY), utf8('prompt'), constant(SFT_ANSWER_KEY)))} AS input_ids
FROM sft, range(4) r(copy)""",
    "dense_index": """SELECT conv_id, turn, role, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx,
       count(*) OVER () AS n_rows FROM conversations""",
    "source_index": f"WITH {NUMBERED_DOCUMENTS} SELECT doc_id, lang, idx, n_rows FROM numbered",
    "rank_split": f"""WITH numbered AS (
  SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, count(*) OVER () AS n
  FROM conversations)
SELECT conv_id, turn, idx, (idx % {Q.RANKS})::INTEGER AS rank, idx // {Q.RANKS} AS pos
FROM numbered WHERE idx < n // {Q.RANKS} * {Q.RANKS}""",
    "seeded_shuffle": f"WITH {SHUFFLED} SELECT conv_id, turn, idx, n_rows FROM shuffled",
    "batch_assign": f"""WITH {SHUFFLED}, {dealt('shuffled')}
SELECT conv_id, turn, rank, batch_id, row_in_batch, rank_steps FROM dealt""",
    "batch_len_longest": f"""{SFT_BATCHES}
SELECT rank, batch_id, row_in_batch, bl::INTEGER AS batch_len FROM sized""",
    "batch_len_shortest": f"""{pair_batches()}
SELECT rank, batch_id, row_in_batch, bl::INTEGER AS shortest_len, longest::INTEGER AS longest_len
FROM sized""",
    "sft_batches": f"{SFT_BATCHES} SELECT rank, batch_id, row_in_batch, {BATCH_TEXT} FROM batches",
    "sft_batches_documents": f"""WITH {DOCUMENT_SAMPLES}, {dealt()}, {SFT_LENGTH}
SELECT rank, batch_id, row_in_batch, {BATCH_TEXT} FROM batches""",
    "dpo_batches": f"""{pair_batches()}
SELECT rank, batch_id, row_in_batch, side, {BATCH_TEXT} FROM batches""",
    "dpo_interleave": f"""{pair_batches()}
SELECT rank, batch_id, row_in_batch, side, {text('ids')} AS ids, {text('labels')} AS labels FROM sides""",
    "shift_align": MOVED_SCORES,
    "shift_align_join": MOVED_SCORES,
    "token_logprob": LABEL_LOGP,
    "token_logprob_rows": LABEL_LOGP,
    "softmax_row": f"WITH {SOFTMAX} SELECT vec_id, token_id, round(p, 8) AS p FROM probs",
    "seq_logprob": f"""{pair_tokens()}
SELECT rank, batch_id, row_in_batch, side, coalesce(sum(policy) {COUNTS}, 0) AS logp,
       count(*) {COUNTS} AS tokens
FROM tokens GROUP BY ALL""",
    "reference_join": f"""{pair_tokens()}
SELECT rank, batch_id, row_in_batch, side, coalesce(sum(policy) {COUNTS}, 0) AS policy_logp,
       coalesce(sum(reference) {COUNTS}, 0) AS reference_logp, count(*) {COUNTS} AS tokens
FROM tokens GROUP BY ALL""",
    "chosen_nll": f"""{pair_tokens()}
SELECT rank, batch_id, round(avg(-policy) {COUNTS}, 8) AS nll_loss, count(*) {COUNTS} AS tokens
FROM tokens WHERE side = 'chosen' GROUP BY rank, batch_id""",
    "sft_batch_loss": f"""{SFT_BATCHES}, {TOKENS}
SELECT rank, batch_id, round(avg(-policy) {COUNTS}, 8) AS loss, count(*) {COUNTS} AS tokens
FROM tokens GROUP BY rank, batch_id""",
    "validation_loss": f"""{SFT_BATCHES}, {TOKENS},
losses AS (SELECT rank, batch_id, avg(-policy) {COUNTS} AS loss FROM tokens GROUP BY rank, batch_id),
per_rank AS (SELECT rank, sum(loss) AS loss FROM losses GROUP BY rank)
SELECT round(avg(loss), 8) AS validation_loss, count(*) AS ranks FROM per_rank""",
    "dpo_loss_sigmoid": pair_loss(SIGMOID),
    "dpo_loss_smoothed": pair_loss(
        f"{SIGMOID} * 0.9::DOUBLE + {nls(f'-{BETA}::DOUBLE * z')} * 0.1::DOUBLE"
    ),
    "dpo_loss_hinge": pair_loss(f"greatest(1 - {BETA}::DOUBLE * z, 0)"),
    "dpo_loss_ipo": pair_loss(f"(z - 1 / (2 * {BETA}::DOUBLE)) * (z - 1 / (2 * {BETA}::DOUBLE))"),
    "dpo_rewards": f"""{pair_scores()}
SELECT rank, batch_id, pair_in_batch, round(chosen_reward, 8) AS chosen_reward,
       round(rejected_reward, 8) AS rejected_reward FROM z""",
    "reward_accuracy": f"""{pair_scores()}
SELECT rank, batch_id, round(avg((chosen_reward > rejected_reward)::INTEGER::DOUBLE), 8) AS reward_accuracy
FROM z GROUP BY rank, batch_id""",
    "margins": f"""{pair_scores()}
SELECT rank, batch_id, round(abs(avg(policy_chosen)) - abs(avg(policy_rejected)), 8) AS margin,
       round(abs(avg(reference_chosen)) - abs(avg(reference_rejected)), 8) AS margin_ref
FROM z GROUP BY rank, batch_id""",
    "dpo_report": f"{report()} SELECT * FROM report",
    "dpo_validation": f"{pair_scores('held_out', 1)} SELECT {REPORT_FIGURES} FROM z",
    "topk_tokens": f"WITH {TOP} SELECT vec_id, place, token_id, round(p, 8) AS p FROM best",
    "topk_rows": f"""WITH {SOFTMAX},
rounded AS (SELECT vec_id, token_id, round(p, 8) AS p FROM probs)
SELECT vec_id, (row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, token_id) - 1)::INTEGER AS place,
       token_id, p
FROM rounded QUALIFY place < {Q.TOP_K}""",
    "topk_draw": f"""WITH {TOP},
drawn AS (
  SELECT vec_id, token_id, p, (('0x' || substr(md5('{Q.SEED}:' || vec_id || ':' || token_id), 1, 13))::BIGINT
         + 0.5::DOUBLE) / 4503599627370496 AS u
  FROM best
)
SELECT vec_id, arg_max(token_id, ln(p) - ln(-ln(u))) AS token_id FROM drawn GROUP BY vec_id""",
    "accum_loss": f"""WITH {STEPS}
SELECT rank, {window_of()} AS window_id, max(step) AS step, count(*) AS steps,
       round(sum(loss / {Q.ACCUMULATION}), 8) AS loss
FROM steps GROUP BY 1, 2 HAVING max(step) = {window_of('max(step)')} * {Q.ACCUMULATION}""",
    "rank_mean_loss": f"""WITH {MEAN_STEPS}
SELECT window_id, step, steps, round(loss, 8) AS loss FROM mean_windows""",
    "throughput": f"""WITH {STEPS},
windows AS (
  SELECT rank, {window_of()} AS window_id, max(step) AS last, arg_max(dt, step) AS last_dt,
         sum(tokens) / sum(dt) AS true_rate
  FROM steps GROUP BY 1, 2 HAVING max(step) = {window_of('max(step)')} * {Q.ACCUMULATION}
)
SELECT rank, window_id, last AS step,
       round({float(Q.BATCH * Q.ACCUMULATION * BATCH_LENGTH * Q.RANKS)}::DOUBLE / last_dt, 8) AS tokens_per_s,
       round({float(Q.BATCH * Q.ACCUMULATION)}::DOUBLE / last_dt, 8) AS rows_per_s,
       round(true_rate, 8) AS true_tokens_per_s
FROM windows""",
    "lr_linear": f"""WITH {STEPS}
SELECT rank, step, {linear('step')} AS lr, {linear(f'(step // {Q.ACCUMULATION})')} AS lr_in_training
FROM steps, total""",
    "lr_ramp": f"""WITH {STEPS}
SELECT rank, step, round({Q.BASE_LR}::DOUBLE * (0.1::DOUBLE + (1 - 0.1::DOUBLE) *
  (least(step, t) / t::DOUBLE)), 9) AS lr FROM steps, total""",
    "lr_cosine": f"""WITH {STEPS}
SELECT rank, step, round(CASE WHEN step < w THEN {Q.MAX_LR}::DOUBLE * (step + 1) / w::DOUBLE
  ELSE {Q.MIN_LR}::DOUBLE + 0.5::DOUBLE * (1 + cos(pi() * ((step - w) / (t - w)::DOUBLE)))
       * ({Q.MAX_LR}::DOUBLE - {Q.MIN_LR}::DOUBLE) END, 9) AS lr FROM steps, total""",
    "cadence": f"""WITH {STEPS}
SELECT rank, step, (step > 0 AND step % {Q.ACCUMULATION} = 0)::INTEGER AS closes_window,
       (step > 0 AND step % {Q.ACCUMULATION} = 0 AND step % {Q.SFT_LOG_EVERY} = 0)::INTEGER AS logs_loss,
       (step > 0 AND step % {Q.SFT_LOG_EVERY} = 0)::INTEGER AS logs_preference,
       (step > 0 AND step % {Q.EVAL_EVERY} = 0)::INTEGER AS evaluates,
       (step > 0 AND step % {Q.SAVE_EVERY} = 0)::INTEGER AS saves
FROM steps""",
    "dpo_log_lines": f"{dpo_lines()} SELECT rank, step, line_in_step, value FROM lines",
    "sft_log_lines": f"WITH {SFT_LINES} SELECT step, kind, value FROM lines",
    "sft_log_parse": f"""WITH {SFT_LINES}
SELECT 'run 5%' AS run_id, step, kind, split_part(value, ' ', 3)::DOUBLE AS loss FROM lines""",
    "null_rows": """SELECT doc_id, concat_ws(',', CASE WHEN source = 'src3' THEN 'source' END,
       CASE WHEN lang = 'es' THEN 'text' END) AS null_columns
FROM documents WHERE source = 'src3' OR lang = 'es'""",
    "unmatched_scores": f"""WITH rows AS (
    SELECT event_id // 16 AS seq_id, event_id % 16 AS pos,
           CASE WHEN event_id % 5 = 0 THEN {IGNORED_LABEL} ELSE event_id % 97 END AS label FROM events
), s AS (SELECT seq_id, pos, true AS score FROM rows WHERE (seq_id + pos) % 11 <> 0),
l AS (SELECT seq_id, pos - 1 AS pos, label FROM rows WHERE (seq_id + pos) % 13 <> 0 AND pos > 0),
c AS (
    SELECT seq_id, count(*) FILTER (score IS NULL AND label <> {IGNORED_LABEL}) AS labels_without_score,
           count(*) FILTER (label IS NULL) AS scores_without_label
    FROM l FULL JOIN s USING (seq_id, pos) GROUP BY seq_id
)
SELECT * FROM c WHERE labels_without_score > 0 OR scores_without_label > 0""",
    "log_parse": f"""{dpo_lines()}
SELECT 'rank' || rank AS run_id, {', '.join(DPO_REPORT_COLUMNS)} FROM logged""",
    "stream_prepare": f"""WITH {SHARD_IDS}
SELECT doc_id, {text('tokens')} AS tokens, least(len(ids), {SHARD_LENGTH})::INTEGER AS length
FROM shard_tokens""",
    "stream_shards": f"""WITH {SHARD_IDS},
parts AS (SELECT doc_id, doc_id % {Q.STREAM_PARTS} AS part FROM documents),
placed AS (
    SELECT doc_id, CASE WHEN part = 0 THEN 0 ELSE part + 1 END AS epoch,
           row_number() OVER (ORDER BY part, doc_id) - 1 AS place FROM parts
)
SELECT epoch::INTEGER AS epoch, (place // {Q.SHARD})::INTEGER AS shard_id, (place % {Q.SHARD})::INTEGER AS row_in_shard,
       doc_id, {text('tokens')} AS tokens, least(len(ids), {SHARD_LENGTH})::INTEGER AS length
FROM placed JOIN shard_tokens USING (doc_id)""",
    "stream_log": f"""WITH {SFT_LINES}
SELECT 'run0' AS run_id, {window_of('step', Q.SFT_LOG_EVERY * 10)} AS window_id,
       round(sum(split_part(value, ' ', 3)::DOUBLE), 8) AS loss, count(*) AS lines
FROM lines WHERE kind = 'train' GROUP BY 1, 2""",
}
