"""Production parameters of the registered queries and the pipeline."""

from __future__ import annotations

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
QUALITY_THRESHOLD = 0.3
TOXIC_THRESHOLD = 0.5
#: Shares of the tokens that each language shall have.
DOMAIN_TARGETS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
