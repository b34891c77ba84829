"""Where the public vocabulary files are."""

from __future__ import annotations


def tokenizer_file(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
