"""Fixed values of the data model and the default settings.

The prompt turns, the rate tiers, the encoding's special names and the option
defaults are part of the result contract: changing one changes outputs.
"""

# --- fixed values: the translation prompt, in turn order -------------------
SYSTEM_PROMPT = (
    "You are a professional translator who translates English into Japanese. "
    "Please translate the received text directly and accurately into Japanese. "
    "Please keep the tone of the original text. Output only the translated text. "
    "Do not use Markdown formatting. Be sure to output the translated Japanese text."
)
EXAMPLE_TURNS = (
    ("user", "The quiet cafe buzzed with ideas as sunlight spilled across half-finished notebooks."),
    ("assistant", "静かなカフェにはアイデアが満ち、差し込む日差しが書きかけのノートを照らしていた。"),
    ("user", "She took a deep breath and stepped forward, trusting that curiosity would guide her way."),
    ("assistant", "彼女は深く息を吸い、好奇心が自分を導いてくれると信じて一歩踏み出した。"),
)

# --- fixed values: rate tiers, (tier, requests/min, tokens/min) ------------
RATE_TIERS = (
    ("1", 500, 200_000),
    ("2", 5_000, 2_000_000),
    ("3", 5_000, 4_000_000),
    ("4", 10_000, 10_000_000),
    ("5", 30_000, 180_000_000),
)
FALLBACK_TIER = "1"
RATE_WINDOW_SECONDS = 60

# --- fixed values: the o200k_harmony encoding (public tokenizer package) ---
ENCODING_NAME = "o200k_harmony"
SPECIAL_NAMES = (
    "startoftext", "endoftext", "endofprompt", "return", "constrain",
    "channel", "start", "end", "message", "call",
)
RESERVED_RANGES = ((200000, 200001), (200004, 200004), (200009, 200011), (200013, 201087))

# --- fixed values: retry policy -------------------------------------------
MAX_RETRIES = 2
RETRY_STEP_SECONDS = 0.5
DEFAULT_RETRY_AFTER_SECONDS = 1.0
RETRY_AFTER_MS_PATTERN = r"(?i)try again in (\d+)ms"
RETRY_AFTER_S_PATTERN = r"(?i)try again in ([0-9.]+)s"

# --- fixed values: option defaults -----------------------------------------
BYTES_PER_TOKEN = 3
MAX_COMPLETION_TOKENS = 4096
TEMPERATURE = 0.3
LOCAL_MODEL = "openai/gpt-oss-20b"
API_MODEL = "gpt-5-nano"
LOCAL_BASE_URL = "http://localhost:8000/v1"
FILTER_MAX_TOKENS = 512
FILTER_MAX_FILE_MB = 300
FILTERED_COLUMN = "en_text"
TEXT_FIELD = "text"
PROFILE_MAX_SAMPLES = 1000
PROFILE_BUCKET_SIZE = 200
PROFILE_PERCENTS = (50, 90, 95, 99)
TRANSLATE_PREFIX = "c4-train-ja-filtered"
SOURCE_COLUMN = "text_en"
TARGET_COLUMN = "text_ja"
ROWS_PER_SHARD = 1000
LOCAL_IN_FLIGHT = 4
JSONL_LOCAL_IN_FLIGHT = 100
API_IN_FLIGHT = 4
PUBLISH_SPLIT = "train"
PUBLISH_MAX_SHARD = "1GB"
