"""Ids of a byte-level BPE tokenizer, and the chunks it takes apart from each other.

The tokenizer's pattern never joins white space that follows other characters to
what stands before it, so a text may be cut before any space, tab or newline after
a character that is none; the ids of a text are those of its chunks.
"""

from __future__ import annotations

import re

_SPACE = " \t-\r"
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: Texts of these characters alone are cut; the tokenizer takes the others whole. No character here but ASCII ones is white space.
_TAME = re.compile("[\x00-\x7fÀ-ɏ¡-¬®-¿‐-‧‰-›€]*")
_RUNS = ("  ", "\n ", "\t ", "\r ", "\x0b ", "\x0c ")


def is_tame(text: str) -> bool:
    return _TAME.fullmatch(text) is not None


def chunks(text: str) -> list[str]:
    """The chunks of a tame text; joined, they are the text."""
    if text[:1] == " " or text[-1:] == " " or any(r in text for r in _RUNS):
        return _CHUNK.findall(text)
    first, *rest = text.split(" ")
    return [*([first] if first else []), *[" " + x for x in rest]]


_encoders: dict = {}

# Fixed value: the pattern that byte-level BPE files of this kind split texts by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same where no white space follows other white space; without looking ahead it is much faster.
_SINGLE = PATTERN.replace(r"|\s+(?!\S)", "")
_TWO_SPACES = re.compile(r"\s\s")


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """Bytes -> id of a byte-level BPE file whose ids are the ranks of its merges; None for other tokenizers."""
    import json

    from cardloom.llm.packing import byte_letters

    own = json.load(open(path, encoding="utf-8"))
    model, before = own["model"], own.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or own.get("normalizer") or before.get("type") != "ByteLevel" or not before.get("use_regex", True) or before.get("add_prefix_space"):
        return None
    special = {t["content"] for t in own.get("added_tokens", [])}
    byte_of = {c: b for b, c in byte_letters().items()}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if sorted(vocab.values()) != list(range(len(vocab))) or merged != list(range(len(vocab) - len(merged), len(vocab))):
        return None
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items()}


def encoder(path: str, special: bool = True):
    """Function: texts -> lists of ids, as the tokenizer in the file gives them; one for each worker.

    special: whether the strings of special tokens in a text are those tokens. Where
    the file's ids are merge ranks, a rank encoder with the same vocabulary gives the same
    ids faster; texts with special tokens, and other files, go through the tokenizer itself.
    """
    if (path, special) in _encoders:
        return _encoders[path, special]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()] if special else []
    ranks = merge_ranks(path)
    if ranks:
        import tiktoken

        exact, single = (tiktoken.Encoding(p, pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary for p in (PATTERN, _SINGLE))

    def encode(texts: list[str]) -> list[list[int]]:
        out = []
        for t in texts:
            if not ranks or any(a in t for a in added):
                out.append(tokenizer.encode(t, add_special_tokens=False).ids)
            else:
                out.append((exact if _TWO_SPACES.search(t) else single)(t))
        return out

    return _encoders.setdefault((path, special), encode)
