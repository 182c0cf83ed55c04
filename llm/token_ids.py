"""Token ids of whole texts, by a public byte-level BPE vocabulary of the tokenizers library.

Encoding a text costs about a second a megabyte, nearly all of it merges inside words. Words repeat, so each Python worker keeps
the ids of the words it has met (a bounded dictionary) and encodes only new ones, a text's new words of plain letters in one call.
Cutting is exact: the vocabulary's pattern never lets a token contain a space but at its start, and a line feed between other
characters is a token, so between a character that is no white space and a space or line feed followed by another such character a
token always ends. Where that can't be told (runs of white space, odd white space beside a space) the whole text is encoded in one
call.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Collection
from functools import lru_cache
from itertools import batched
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Characters that some versions of the pattern's `\\s` take for white space and Python's `isspace` may not, or the reverse.
ODD_SPACE = "\x1c\x1d\x1e\x1f\x85\xa0\u180e\u200b\u2060\ufeff"
#: Letters whose class is the same in every Unicode version, at the start of a line perhaps, then marks but the apostrophe: the letters
#: and the marks are separate tokens.
PLAIN = re.compile("(\n?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
#: Words of one generation, passed by one text's words at most. Two are kept: a full one becomes the older, from which words in use
#: move back to the newer.
WORDS_KEPT = 500_000
#: New words of plain letters that go through the merges together.
WORDS_A_CALL = 1_000

_ENCODERS: dict[str, Callable[[str | None], bytes]] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(vocabulary: str) -> Callable[[str | None], bytes]:
    """A function from a text (null: empty) to its ids as little-endian unsigned 32-bit integers; one per worker process."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = _encoder(vocabulary)
    return _ENCODERS[vocabulary]


def _encoder(vocabulary: str) -> Callable[[str | None], bytes]:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    letters = _plain_words(tokenizer)
    newer: dict[str, bytes] = {}  # ids of words after a space; with a line feed in front, of that and the word
    older: dict[str, bytes] = {}

    def whole(text: str) -> bytes:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def odd(word: str) -> bool:
        return not word or word[0].isspace() or word[-1].isspace() or word[0] in ODD_SPACE or word[-1] in ODD_SPACE

    def learn(words: set[str]) -> dict[str, bytes] | None:
        """Ids of words that the newer generation lacks, which keeps them; None if no cut is certain beside one."""
        nonlocal newer, older
        found: dict[str, bytes] = {}
        stopped: list[tuple[str, str, str]] = []
        fresh: set[str] = set()
        for word in words:
            if (ids := older.get(word)) is not None:
                found[word] = ids
            elif plain := PLAIN.fullmatch(word):
                stem, stop = plain.groups()
                if stop:
                    stopped.append((word, stem, stop))
                    if stem not in newer and stem not in words:
                        if (ids := older.get(stem)) is not None:
                            found[stem] = ids
                        else:
                            fresh.add(stem)
                else:
                    fresh.add(stem)
            elif word.startswith("\n"):
                if odd(word[1:]):
                    return None
                found[word] = newline + whole(word[1:])
            elif odd(word):
                return None
            else:
                found[word] = whole(f" {word}")
        if fresh:
            found.update(zip(fresh, letters(fresh), strict=True))
        for word, stem, stop in stopped:
            found[word] = (found.get(stem) or newer[stem]) + marks(stop)
        if len(newer) >= WORDS_KEPT:
            newer, older = {}, newer
        newer.update(found)
        return found

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        words = text.replace("\n", " \n").split(" ")
        words[0] = f"\n{words[0]}"
        ids = list(map(newer.get, words))
        holes = [i for i, known in enumerate(ids) if known is None]
        if holes:
            if (found := learn({words[i] for i in holes})) is None:
                return whole(text)
            for i in holes:
                ids[i] = found[words[i]]
        return b"".join(ids)[len(newline):]

    marks = lru_cache(1000)(whole)
    newline = whole("\n")
    return encode


def _plain_words(tokenizer: Tokenizer) -> Callable[[Collection[str]], list[bytes]]:
    """A function from words of plain letters to their ids: one run of the vocabulary's merges for all of them.

    Each word stands after a space or line feed. No token of these characters reaches from a letter into the next word, and none
    joins a line feed to letters, so the run gives each word what it has alone.
    """
    import numpy as np
    from tokenizers import Tokenizer, pre_tokenizers

    bare = Tokenizer(tokenizer.model)
    bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)  # spells bytes, cuts nothing
    spelled = {c: "".join(part for part, _ in bare.pre_tokenizer.pre_tokenize_str(c)) for c in
               map(chr, [10, 32, *range(65, 91), *range(97, 123), *range(0xC0, 0x100)])}
    fronts, known = spelled["\n"] + spelled[" "], set("".join(spelled.values()))
    begins = np.zeros(max((vocabulary := bare.get_vocab()).values()) + 1, bool)
    for token, n in vocabulary.items():
        begins[n] = token[0] in fronts
        stem = token.strip(fronts)
        if stem and known.issuperset(token) and (stem != token.removeprefix(spelled[" "]) or not set(fronts).isdisjoint(stem)):
            raise ValueError(f"token {token!r} reaches over the end of a word")

    def ids_of(words: Collection[str]) -> list[bytes]:
        found: list[bytes] = []
        for some in batched(words, WORDS_A_CALL):
            text = f" {' '.join(some)}".replace(" \n", "\n")
            ids = np.array(bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            data, starts = ids.tobytes(), (np.flatnonzero(begins[ids]) * 4).tolist()
            found += [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]
        return found

    return ids_of
