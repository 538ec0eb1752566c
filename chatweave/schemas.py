"""Schemas shared by sources and operators."""

MESSAGE = "struct<role:string,content:string>"
MESSAGES = f"array<{MESSAGE}>"

CHAT_ROWS = f"messages {MESSAGES}"
SESSION_INPUT = "conv_id bigint, turn bigint, text string, reply string"
TOKEN_STREAM = "id bigint, seq int, token string, is_last boolean"
CANDIDATES = "group_id bigint, cand int, score double"
PROMPTS = "idx int, name string, system string, prompt string, max_new_tokens int"
ADAPTER_CONFIG = (
    "base_model_name_or_path string, r int, lora_alpha int, target_modules array<string>"
)
DEVICE_INFO = (
    "cuda_available boolean, device_count int, "
    "devices array<struct<index:int,name:string,total_memory_gb:double>>"
)
TELEMETRY_LINES = "ingest_ts timestamp, line string"
