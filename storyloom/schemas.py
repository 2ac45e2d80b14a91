"""Fixed schemas, declared once, as DDL text (it needs no session to be imported)."""

from __future__ import annotations

MESSAGE = "role string, content string, reasoning string, reasoning_content string"
CHATML_ROW = "messages array<struct<role: string, content: string, reasoning: string, reasoning_content: string>>"
TEXT_ROW = "text string"
SCENE = "scene_id string, source_file string, start_line int, end_line int, content string, char_count int"
CHARACTER = "name string, alias array<string>, frequencies map<string, int>, consecutive_over_limit int"
SEGMENT_CHARACTERS = "is_pov boolean, pov_name string, characters array<string>"
FACTS = "environment_facts array<string>, character_facts array<struct<name: string, facts: array<string>, representative_quote: string>>, summary string"
DIALOGUE = "context_summary string, messages array<struct<speaker: string, content: string>>"
STATUS_FIELDS = ("health", "mood", "location", "hair", "makeup", "accessories", "posture", "outerwear", "top", "bottom", "socks", "shoes")
DATA_BLOCK = (
    "dataType string, line_count int, content string, speaker string, actor string, target string, character string, "
    f"updates struct<{', '.join(f'{f}: string' for f in STATUS_FIELDS)}>, opinion string, new_event string, item_name string, action string, new_state string, new_scene string"
)
SCENE_FILE = "start_line int, end_line int, plot_summary string, character_states map<string, string>, character_relationships map<string, string>, character_items map<string, string>, data_blocks array<struct<dataType: string, content: string>>"
CHARACTER_CARD = (
    "profile struct<name: string, identity: string, impression: string>, personality struct<keywords: array<string>, logic: string, ethics: string>, "
    "linguistic_fingerprint struct<tone: string, habit: string, address: string>, knowledge_boundary struct<known: array<string>, bias: string>, sample_dialogue array<string>"
)
NOVEL_ANNOTATION = f"worldview string, character_cards array<struct<{CHARACTER_CARD}>>, unknown boolean"
CATALOG = "Uid string, Title string, tags string"
RECORD = "id string, type string, name string, timestamp string, depth int, input string, output string, metadata string, created_at string"
ANNOTATION_SCHEMA = "id bigint, name string, created_at string"
SCHEMA_FIELD = "id bigint, schema_id bigint, name string, label string, type string, options string, order_idx int"
QUEUE = "id bigint, name string, schema_id bigint, created_at string"
QUEUE_ITEM = "id bigint, queue_id bigint, record_id string, status string, created_at string"
ANNOTATION = "id bigint, queue_item_id bigint, values string, updated_at string"
DATASET = "id bigint, name string, created_at string"
DATASET_ITEM = "id bigint, dataset_id bigint, record_id string, source string, queue_item_id bigint"
TOOL_CALLS = "array<struct<id: string, function: struct<name: string, arguments: string>>>"
CHECKPOINT = "current_line int, processed_scenes int, state_data string"
