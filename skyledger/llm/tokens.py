"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import base64
import re

import numpy as np

from skyledger.session import send_code_with_tasks

send_code_with_tasks(__name__)

#: The pre-tokenizer's pattern of the byte-level vocabularies (a fixed value).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Signs that both pattern engines are known to class alike; a text with others is given
# to the slower library, which is the one that defines the ids.
PLAIN = re.compile("[\t\n\r -~¡-ɏ]*")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Encoders a worker keeps, by their file (see ``textbytes.KEPT``).
ENCODERS: dict = {}


def rank_encoder(path: str):
    """The encoder of a file of ranks."""
    import tiktoken

    if path in ENCODERS:
        return ENCODERS[path]
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ENCODERS[path]


def json_encoder(path: str):
    """The encoder that defines the ids."""
    from tokenizers import Tokenizer

    if path not in ENCODERS:
        ENCODERS[path] = Tokenizer.from_file(path)
    return ENCODERS[path]


def encode(text: str, json_path: str, rank_path: str) -> np.ndarray:
    """Ids of a text as ``tokenizers`` gives them for ``json_path`` without special tokens.

    ``rank_path`` holds the same vocabulary as ranks, which a text of plain signs without
    a special token's string is encoded with, six times as fast and with the same ids.
    """
    if "<|" not in text and PLAIN.fullmatch(text):
        return rank_encoder(rank_path).encode_to_numpy(text)
    return np.array(json_encoder(json_path).encode(text, add_special_tokens=False).ids, dtype=np.uint32)
