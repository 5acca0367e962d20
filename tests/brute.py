"""Plain-Python statements of what the operators must give on small inputs."""

from __future__ import annotations

import math

IGNORED = -100


def fit(items, length, fill):
    return [items[i] if i < len(items) else fill for i in range(length)]


def mask_of(n, length):
    return [int(i < n) for i in range(length)]


def deal(n_rows, ranks, batch):
    """idx -> (rank, batch_id, row_in_batch) of every row that is kept."""
    each = n_rows // ranks
    return {
        pos * ranks + rank: (rank, pos // batch, pos % batch)
        for rank in range(ranks) for pos in range(each)
    }


def sft_batches(rows, encode, ranks, batch, limit):
    """rows: ordered (prompt, answer); result keyed by (rank, batch_id, row_in_batch)."""
    samples = []
    for prompt, answer in rows:
        prefix = encode("### Question: ") + encode(prompt) + encode("\n ### Answer:")
        reply = encode(answer)
        samples.append((prefix + reply, [IGNORED] * len(prefix) + reply))
    place = deal(len(rows), ranks, batch)
    longest = {}
    for idx, (rank, b, _) in place.items():
        longest[rank, b] = max(longest.get((rank, b), 0), len(samples[idx][0]))
    out = {}
    for idx, (rank, b, r) in place.items():
        ids, labels = samples[idx]
        length = min(limit, longest[rank, b])
        out[rank, b, r] = (
            fit(ids, length, 50256), mask_of(len(ids), length), fit(labels, length, IGNORED)
        )
    return out


def dpo_batches(rows, encode, ranks, batch, limit, pick=min):
    """rows: ordered (prompt, chosen, rejected); keyed by (rank, batch_id, row_in_batch)."""
    samples = []
    for prompt, *replies in rows:
        prefix = encode("Question: ") + encode(prompt) + encode("\n\nAnswer: ")
        sides = []
        for reply in map(encode, replies):
            sides.append((prefix + reply, [IGNORED] * len(prefix) + reply))
        samples.append(sides)
    place = deal(len(rows), ranks, batch)
    by_batch = {}
    for idx, (rank, b, _) in place.items():
        by_batch.setdefault((rank, b), []).append(max(len(s[0]) for s in samples[idx]))
    out = {}
    for idx, (rank, b, r) in place.items():
        length = min(limit, pick(by_batch[rank, b]))
        for offset, (ids, labels) in enumerate(samples[idx]):
            out[rank, b, 2 * r + offset] = (
                fit(ids, length, 50256), mask_of(len(ids), length), fit(labels, length, IGNORED)
            )
    return out


def shard_tokens(ids, length, end):
    if len(ids) > length:
        return ids[: length - 1] + [end]
    return fit(ids, length, end)


def log_softmax_at(logits, label):
    top = max(logits)
    return logits[label] - top - math.log(sum(math.exp(x - top) for x in logits))
