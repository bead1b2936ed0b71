"""Token ids of whole texts, with the words a worker has met kept in memory.

The tokenizer drops white space and never joins characters across it, so the ids of a text are those
of its words put together. Words of printable ASCII and Latin-1 letters are cut by the tokenizer's own
split rule and given to its BPE model piece by piece; any other word, and one that could hold a special
token, goes through the whole tokenizer. Both caches stop growing at a fixed number of entries.

This holds for vocabularies with the rules below. The rules are read from the file, and where any differs the whole
text goes through the tokenizer.
"""

from __future__ import annotations

import json
import re

# The split rule of the vocabulary file for the letters the fast path takes, and the byte
# ranges that byte-level BPE shows as themselves.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
SHOWN = (*range(33, 127), *range(161, 173), *range(174, 256))

# The rules of the vocabulary file under which words can be taken one by one.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
PRETOKENIZERS = [
    {
        "type": "Split",
        "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
MODEL = {"type": "BPE", "dropout": None, "byte_fallback": False, "ignore_merges": False}
ADDED = {"single_word": False, "lstrip": False, "rstrip": False}

CACHE_WORDS = 2**17
END_ID = 1


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    hidden = (b for b in range(256) if b not in SHOWN)
    return {**{b: chr(b) for b in SHOWN}, **{b: chr(256 + n) for n, b in enumerate(hidden)}}


def by_words(vocabulary: str) -> bool:
    """Whether the file has the rules under which a text's ids are those of its words put together."""
    rules = json.loads(vocabulary)
    normalizer, split, model = (rules.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and split.get("pretokenizers") == PRETOKENIZERS
        and all(model.get(k) == v for k, v in MODEL.items())
        and all(
            "<|" in token["content"] and not re.search(r"\s", token["content"]) and all(token[k] == v for k, v in ADDED.items())
            for token in rules.get("added_tokens") or []
        )
    )


class WordIds:
    """The ids of a text as little-endian 32-bit numbers."""

    def __init__(self, vocabulary: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        # Cut and padded ids would not be those of the whole text.
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_words = by_words(vocabulary)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        shown = piece.encode().decode("latin-1").translate(self.letters)
        ids = b"".join([x.id.to_bytes(4, "little") for x in self.model.tokenize(shown)])
        if len(self.pieces) < CACHE_WORDS:
            self.pieces[piece] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([x.to_bytes(4, "little") for x in found])

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if PLAIN.fullmatch(text) and "<|" not in text:
            known = self.pieces
            ids = b"".join([known.get(p) or self._piece(p) for p in PIECE.findall(text.lower())])
        else:
            ids = self._whole(text)
        if len(self.words) < CACHE_WORDS:
            self.words[word] = ids
        return ids

    def of(self, text: str | None) -> bytes:
        if not self.by_words:
            return self._whole(text or "")
        known = self.words
        return b"".join([known.get(w) or self._word(w) for w in (text or "").encode().split()])


_READY: dict[int, WordIds] = {}


def word_ids(vocabulary: str) -> WordIds:
    """The one instance a Python worker keeps for a vocabulary."""
    key = hash(vocabulary)
    if key not in _READY:
        _READY[key] = WordIds(vocabulary)
    return _READY[key]
