"""Reads a byte-level BPE file; the tables are bounded by the vocabulary and may be broadcast."""

from __future__ import annotations

import hashlib
import json

# Fixed value: the split into pieces that byte-level files of this kind are made for.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: visible bytes are themselves, others follow from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(visible) else chr(next(hidden)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """Ids by symbol, merges in order of rank, special strings with their ids, end-of-word mark, split pattern."""
    with open(path, "rb") as f:
        data = f.read()
    content = json.loads(data)
    model = content["model"]
    if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
        raise ValueError("a plain BPE model is expected")
    merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
    split = next((p["pattern"]["Regex"] for p in (content["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"), PIECES)
    return {
        "ids": model["vocab"],
        "merges": merges,
        "special": {t["content"]: t["id"] for t in content.get("added_tokens", [])},
        "word_end": model.get("end_of_word_suffix") or "",
        "split": split,
        "digest": hashlib.sha256(data).hexdigest(),
    }
