"""They must be exactly these for results to be compatible."""

# Text pieces put around the columns of one row.
SFT_PROMPT_KEY = "### Question: "
SFT_ANSWER_KEY = "\n ### Answer:"
DPO_PROMPT_KEY = "Question: "
DPO_ANSWER_KEY = "\n\nAnswer: "
SHARD_USER_FORMAT = "### User:"
SHARD_ASSISTANT_FORMAT = "### Assistant:"

# Token ids.
END_OF_TEXT = "<|endoftext|>"
END_OF_PROMPT = "<|endofprompt|>"
PAD = "<|pad|>"
END_OF_TEXT_ID = 50256
END_OF_PROMPT_ID = 50257
PAD_ID = 50258
IGNORED_LABEL = -100
ID_LIMIT = 65536

# Shard defaults.
SHARD_ROWS = 1_000_000
SHARD_LENGTH = 256

# Batch defaults.
BATCH_LENGTH = 1024
BATCH_ROWS = 32

# Preference loss defaults.
BETA = 0.1
LABEL_SMOOTHING = 0.0

# Text-splitting pattern of the byte-pair vocabulary.
BPE_PATTERN = (
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

# Columns of the preference log, in file order, and their separator.
DPO_LOG_COLUMNS = (
    "step", "loss", "reward_accuracy", "logp_chosen", "logp_rejected",
    "logp_chosen/ref", "logp_rejected/ref", "margin", "margin/ref",
    "nll_loss", "lr", "row/s",
)
DPO_LOG_SEPARATOR = "; "
