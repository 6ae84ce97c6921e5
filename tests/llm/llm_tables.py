"""Schemas of the tables that these operators read."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SCHEMAS = {
    "documents": DOCUMENTS,
    "embeddings": "vec_id long, embedding array<float>, label int",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}
