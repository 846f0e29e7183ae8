"""Token ids of whole texts, through the tokenizers library (.json) or sentencepiece (.model).

A worker asks the library once per distinct piece, not once per occurrence.  Texts are cut
before every run of white space, and between a word of Latin letters and the punctuation
behind it.  The pre-tokenizers of the supported files never join characters across such a
cut, so the ids of a text are the ids of its pieces in order.  For a file where that is not
certain (special tokens that could be cut, an unknown pre-tokenizer) whole texts are asked for.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

PIECES = re.compile(r"\s*[A-Za-zÀ-ÖØ-öø-ɏ]+(?![^\s.,;:!?#$%&*])|[.,;:!?#$%&*]+(?!\S)|\s*\S+|\s+")
# words whose letters stay single letters in lower case
WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-įı-ɏ]{1,64}")
BLANK = re.compile(r"(?<=\S)(?=\s)")
#: pieces a worker remembers; beyond it, it starts afresh
MEMORY = 1_000_000
#: characters of a text that are cut into pieces at a time
STRETCH = 1 << 20


class _Memory(dict):
    """Piece to its ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, model, spec: dict):
        super().__init__()
        self._model, self._words, self._spell = model, model.model, _speller(spec)

    def __missing__(self, piece: str) -> bytes:
        if WORD.fullmatch(piece):  # one pre-token for certain: the vocabulary model alone is enough
            ids = array("I", [t.id for t in self._words.tokenize(self._spell(piece))]).tobytes()
        else:
            ids = array("I", self._model.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Encoder:
    """Ids of texts for one tokenizer file, without added begin, end or special tokens."""

    def __init__(self, path: str):
        self._memory: _Memory | None = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._ask = lambda text: array("I", model.encode(text)).tobytes()
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        self._ask = lambda text: array("I", model.encode(text, add_special_tokens=False).ids).tobytes()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if _cuts_hold(spec):
            self._memory = _Memory(model, spec)

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers, one after the other."""
        if self._memory is None:
            return self._ask(text) if text else b""
        if len(text) > STRETCH:
            return b"".join(map(self._ids, _stretches(text)))
        return self._ids(text)

    def _ids(self, text: str) -> bytes:
        if len(self._memory) > MEMORY:
            self._memory.clear()
        return b"".join(map(self._memory.__getitem__, PIECES.findall(text)))


def _stretches(text: str) -> Iterator[str]:
    """A long text in parts, cut where white space begins."""
    at = 0
    while at < len(text):
        cut = BLANK.search(text, at + STRETCH)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _speller(spec: dict) -> Callable[[str], str]:
    """How a word is spelled in the vocabulary: normalised, and every byte as the letter that stands for it."""
    # the byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters = {b: b for b in plain} | {b: 256 + n for n, b in enumerate(sorted(set(range(256)) - plain))}
    normal = spec.get("normalizer") or {}
    lower = any(step["type"] == "Lowercase" for step in normal.get("normalizers") or [normal] if step)
    drops = any(step.get("type") == "Split" for step in _pre_tokenizers(spec))

    def spell(word: str) -> str:
        word = word.strip() if drops else word
        word = word.lower() if lower else word
        return word.encode().decode("latin-1").translate(letters)

    return spell


def _pre_tokenizers(spec: dict) -> list[dict]:
    before = spec.get("pre_tokenizer") or {}
    return before.get("pretokenizers") or [before]


def _cuts_hold(spec: dict) -> bool:
    """Whether a cut at ``PIECES`` is one that the tokenizer makes anyway."""
    for token in spec.get("added_tokens") or []:
        # "<" is part of uncut pieces only, and those reach to the next white space
        if not re.fullmatch(r"<\S*", token["content"]) or token.get("lstrip") or token.get("rstrip") or token.get("single_word"):
            return False
    normal = spec.get("normalizer") or {}
    for step in normal.get("normalizers") or ([normal] if normal else []):
        if step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"}:
            continue
        if step["type"] not in ("NFC", "Lowercase"):
            return False
    steps = _pre_tokenizers(spec)
    if steps[-1].get("type") != "ByteLevel" or steps[-1].get("add_prefix_space") or (spec.get("model") or {}).get("type") != "BPE":
        return False
    if len(steps) == 1:
        return steps[0].get("use_regex", True)
    regex = steps[0].get("pattern", {}).get("Regex", "")
    dropped = steps[0].get("behavior") == "Removed" and steps[0].get("invert", False)
    return len(steps) == 2 and dropped and r"[\p{L}]+" in regex and r"[^\s\p{L}\p{N}]+" in regex


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file; it outlives a task, and what it remembers with it."""
    return Encoder(path)
