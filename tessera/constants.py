"""Fixed values that results depend on.

Everything in the FIXED VALUES block must equal what the original scripts
use; it is stated plainly, in natural order, in one place.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original data-preparation scripts)
# ---------------------------------------------------------------------------

# Audit / prepare gates
MIN_VIEWS = 1000
EXCLUDE_WARNINGS = ["Sexual Content", "Disturbing Content"]
EXCLUDE_GENRES = ["Grimdark", "Harem"]

# Clean-story corpus
MIN_TOKENS = 4096
MAX_TOKENS = 8192
UNTITLED = "<untitled>"
TITLE_TEMPLATE_PREFIX = "Chapter title: "

# Author flag rule
FLAG_MIN_TOTAL = 3
FLAG_MIN_BAD = 2
FLAG_MAX_RATIO = 0.1
HISTOGRAM_BINS = 40
TOP_FLAGGED = 20

# Tokenizer special tokens, in id order (ids 0..27)
CHATML_TOKENS = ["<|im_start|>", "<|im_end|>"]
HOUSE_TOKENS = ["<bos>", "<eos>", "<pad>", "<unk>"]
OPERATORS = ["==", "!=", ">=", "<=", "+=", "-=", "*=", "/=", "//", "**", "->", "=>"]
DIGITS = ["0", "1", "2", "3", "4", "5", "6", "7", "8", "9"]
SPECIAL_TOKENS = CHATML_TOKENS + HOUSE_TOKENS + OPERATORS + DIGITS

BOS, EOS, PAD, UNK = "<bos>", "<eos>", "<pad>", "<unk>"
VOCAB_SIZE = 16384
MIN_FREQUENCY = 2
MODEL_MAX_LEN = 8192
TOKENIZER_TYPE = "ByteLevel‑BPE"

# Byte-level pre-tokenizer pattern (public GPT-2 pattern)
BYTELEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# ChatML literals
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
ASSISTANT_HEADER = "<|im_start|>assistant\n"

# Labels / padding
IGNORE_INDEX = -100

# Split and shuffle
SEED = 42
TEST_FRACTION = 0.01
CODE_TEST_FRACTION = 0.005

# Chat context handling
HISTORY_KEEP_LAST = 39
HISTORY_MAX = 40

# Length statistics thresholds
LEN_OVER_1 = 4096
LEN_OVER_2 = 6144
SHORT_LEN = 100
HEAD_ROWS = 1000

# Corpus phases: config, row target (None = all rows), sequence length,
# test fraction, batch size, gradient accumulation, epochs, assumed seconds
# per step (None = not stated)
PHASES = {
    "phase1": ("cosmopedia-v2", 20_000_000, 512, 0.01, 16, 16, 2, None),
    "phase2": ("clean-stories", None, 8192, 0.01, 2, 64, 3, None),
    "phase3": ("sample-10BT", 10_000_000, 2048, 0.01, 8, 32, 1, 2.5),
    "phase4": ("cosmopedia-v2", None, 2048, 0.01, 8, 32, 1, 2.5),
    "phase5": ("python-edu", 7_680_000, 2048, 0.005, 8, 32, 1, 2.5),
    "sft": ("smol-smoltalk", 460_341, 8192, 0.01, 4, 64, 3, 3.0),
}
LONG_STORY_MIN_TOKENS = 1000

# ---------------------------------------------------------------------------
# end of FIXED VALUES
# ---------------------------------------------------------------------------

# Default system message for conversations that lack one (a parameter of
# seed_system; not a fixed value)
DEFAULT_SYSTEM_PROMPT = "You are a helpful AI assistant."

SPECIAL_IDS = {tok: i for i, tok in enumerate(SPECIAL_TOKENS)}
PAD_ID = SPECIAL_IDS[PAD]
UNK_ID = SPECIAL_IDS[UNK]
