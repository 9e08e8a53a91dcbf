"""Token ids of whole texts, by the tokenizers library.

Both vocabularies used here cut a text before the first blank after a word, whatever stands
around it, so runs of blanks and letters are encoded once and remembered. They also cut it
between a letter and a sign and after a single line feed, so words are remembered without
their signs. Arrow tells the different runs of a batch and puts their ids in the places of
the runs. A text with other white space is encoded as it stands.
"""

from __future__ import annotations

import gc
import os
import re
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 500_000
LONGEST = 64
LETTERS_AT_ONCE = 1 << 22

# all white space but blanks and line feeds
OTHER_WHITE = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _other_white(text: str) -> bool:
    return any(map(text.__contains__, OTHER_WHITE))


def _runs(texts: Sequence[str], fine: bool = False) -> tuple[pa.Array, np.ndarray]:
    """Runs of `[ \\n]*[^ \\n]+|[ \\n]+` of texts without other white space, and where each text's begin.

    A cut goes before each blank and line feed, but not between them; fine cuts also go
    between a letter and a sign and after a line feed alone. The runs are places in the
    bytes of all texts; the last number is how many there are.
    """
    coded = [t.encode() for t in texts]
    data = b"".join(coded)
    begin = np.cumsum([0, *map(len, coded)], dtype=np.int64)
    of_byte = np.frombuffer(data, np.uint8)
    kind = KINDS[of_byte]
    white = kind == WHITE
    cut = white.copy()
    cut[1:] &= ~white[:-1]
    if fine:
        letter = kind == LETTER
        letter[1:] |= (of_byte[:-1] == LATIN_LEAD) & LATIN_LETTER[of_byte[1:]]
        cut[1:] |= letter[:-1] & (kind[1:] == SIGN)
        feeds = np.flatnonzero(of_byte[:-1] == 10)
        alone = ~white[np.maximum(feeds - 1, 0)] | (feeds == 0)
        cut[feeds[alone & ~white[feeds + 1]] + 1] = True
    cut[begin[:-1][np.diff(begin) > 0]] = True
    at = np.flatnonzero(cut).astype(np.int64)
    places = pa.py_buffer(np.append(at, len(data)))
    runs = pa.Array.from_buffers(pa.large_string(), len(at), [None, places, pa.py_buffer(data)])
    return runs, np.searchsorted(at, begin)


def _chunks(text: str) -> list[str]:
    return _runs([text])[0].to_pylist()


def _groups(texts: Sequence[str]) -> Iterator[list[str]]:
    """The texts in order, in groups of at most LETTERS_AT_ONCE characters or one text."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > LETTERS_AT_ONCE:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


# a word of Latin letters
_plain = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+").fullmatch
# an apostrophe is no sign here, it may start a piece of its own
SIGNS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")

WHITE, LETTER, SIGN = 1, 2, 3
KINDS = np.zeros(256, np.uint8)
KINDS[[*b" \n"]], KINDS[[*SIGNS.encode()]] = WHITE, SIGN
KINDS[[b for b in range(128) if chr(b).isalpha()]] = LETTER
# UTF-8 of the letters from U+00C0 to U+00FF: this byte and one more
LATIN_LEAD = 0xC3
LATIN_LETTER = np.array([0x80 <= b < 0xC0 and chr(b + 0x40).isalpha() for b in range(256)])


def _byte_letters() -> dict[int, str]:
    """Latin letters as byte-level vocabularies spell them: a character for each UTF-8 byte.

    Bytes that print stand for themselves, the others for characters from 256 on, in order.
    """
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    spelling = {b: b if b in prints else next(others) for b in range(256)}
    return {c: "".join(chr(spelling[b]) for b in chr(c).encode()) for c in range(0xC0, 0x100)}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes; remembers at most about REMEMBERED runs.

    The first runs met are kept: most words that are common at all are among them. When they
    no longer are, and more than half of a batch's different runs are new, all are forgotten
    for those of that batch. A new word (`_plain`) goes to the vocabulary's merges without
    the steps before them, which change nothing in it but case. That this is so, and that
    signs and a line feed can be cut off, is tried when the vocabulary is loaded.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        # the text of a control token is ordinary text
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.letters = _byte_letters()
        self.four = [_packed([i]) for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.tokenize = self.tokenizer.model.tokenize
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.lower = normal is not None and normal.normalize_str("A") == "a"
        self.blank = "\u0120" if cut is not None and cut.pre_tokenize_str(" a")[0][0] == "\u0120a" else ""
        self.direct = True
        self.direct = self._merges_agree()

    def _merges_agree(self) -> bool:
        letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *self.letters) if chr(c).isalpha()]
        tries = [f"{b}{x}{y}e{s}" for b in ("", " ") for x in letters for y, s in (("", ""), ("n", "."))]
        tries += [f" a{s}{t}" for s in SIGNS for t in SIGNS]
        tries += [f"{b}{x}{s}" for b in ("", "\n", "1\n") for x in letters for s in SIGNS]
        return self._of_texts(tries) == self._encode(tries)

    def _encode(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_packed(e.ids) for e in found]

    def _encode_words(self, words: Sequence[str]) -> list[bytes]:
        """The ids of plain words."""
        four, tokenize, blank = self.four, self.tokenize, self.blank
        spelt = [w.lower() for w in words] if self.lower else words
        spelt = [w if w.isascii() else w.translate(self.letters) for w in spelt]
        spelt = [blank + w[1:] if w[0] == " " else w for w in spelt]
        return [b"".join([four[t.id] for t in tokenize(w)]) for w in spelt]

    def _encode_runs(self, runs: Sequence[str]) -> list[bytes]:
        """The ids of different runs."""
        out = list(map(self.known.get, runs))
        words, rest = [], []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            run = runs[k]
            word = run[1:] if run[0] == " " else run
            plain = self.direct and len(run) <= LONGEST and (word.isascii() and word.isalpha() or _plain(word))
            (words if plain else rest).append(k)
        new = [(k, ids) for k, ids in zip(words, self._encode_words([runs[k] for k in words]))]
        new += [(k, ids) for k, ids in zip(rest, self._encode([runs[k] for k in rest]))]
        full = len(self.known) >= REMEMBERED
        if full and 2 * len(new) > len(runs):
            self.known, full = {}, False
        for k, ids in new:
            out[k] = ids
        if not full:
            self.known.update((runs[k], ids) for k, ids in new if len(runs[k]) <= LONGEST)
        return out

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text; null is the empty text.

        Python's search for cycles rests meanwhile: none are made, and the many lists set it off.
        """
        searched = gc.isenabled()
        gc.disable()
        try:
            odd = [bool(t) and _other_white(t) for t in texts]
            cut = [t or "" for t, whole in zip(texts, odd) if not whole]
            found = (ids for group in _groups(cut) for ids in self._of_texts(group))
            return [self._encode([t])[0] if whole else next(found) for t, whole in zip(texts, odd)]
        finally:
            if searched:
                gc.enable()

    def _of_texts(self, texts: Sequence[str]) -> list[bytes]:
        runs, first = _runs(texts, self.direct)
        coded = runs.dictionary_encode()
        found = self._encode_runs(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        places = np.cumsum([0, *map(len, found)], dtype=np.int64)
        buffers = [None, pa.py_buffer(places), pa.py_buffer(b"".join(found))]
        ids = pa.Array.from_buffers(pa.large_binary(), len(found), buffers)
        of_texts = pa.LargeListArray.from_arrays(first, ids.take(coded.indices))
        return pc.binary_join(of_texts, pa.scalar(b"", pa.large_binary())).to_pylist()


@lru_cache(maxsize=4)
def encoder(vocabulary: str) -> Encoder:
    """One encoder for each vocabulary and worker process."""
    return Encoder(vocabulary)


@lru_cache(maxsize=4)
def vocabulary_size(vocabulary: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary).get_vocab_size()
