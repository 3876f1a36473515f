"""Byte-level BPE ids, the same as those of a ``tokenizers`` file.

The file's vocabulary and added tokens drive the ``tiktoken`` encoder, which
gives the ids of ``tokenizers`` several times faster; added tokens that a text
spells out are found as ``tokenizers`` finds them.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np

#: Fixed: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space as the pattern's ``\s`` has it (Python's also has U+001C to U+001F).
SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Runs of white space from this length on do not go through the encoder's regex, which fails on very long ones.
LONG_RUN = 10_000


@cache
def byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def byte_encoder(path: str):
    """An encoder of the ``tokenizers`` file at ``path`` (one a worker process)."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    table = byte_of_char()
    ranks = {bytes(table[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


@cache
def _long_run():
    return re.compile(rf"(?<!{SPACE}){SPACE}{{{LONG_RUN},}}")


def encode(path: str, text: str, special: bool = True) -> np.ndarray:
    """The ids of a text; without ``special``, added tokens that it spells out are plain text."""
    encoder = byte_encoder(path)
    if len(text) < LONG_RUN or not _long_run().search(text):
        return encoder.encode_to_numpy(text, allowed_special="all" if special else set(), disallowed_special=())
    # \s+(?!\S): a run is one piece up to its last character, which starts the next piece, or whole at the end of
    # the text or before an added token
    added = sorted(encoder.special_tokens_set, key=len, reverse=True) if special else []
    parts = re.split("(" + "|".join(map(re.escape, added)) + ")", text) if added else [text]
    out = []
    for k, part in enumerate(parts):
        if k % 2:
            out.append(np.array([encoder.encode_single_token(part)], np.uint32))
            continue
        at = 0
        for m in _long_run().finditer(part):
            end = m.end() if m.end() == len(part) else m.end() - 1
            out.append(encoder.encode_to_numpy(part[at:m.start()], allowed_special=set(), disallowed_special=()))
            out.append(np.array(encoder._encode_single_piece(part[m.start():end]), np.uint32))
            at = end
        out.append(encoder.encode_to_numpy(part[at:], allowed_special=set(), disallowed_special=()))
    return np.concatenate(out)
