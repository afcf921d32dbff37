"""Encoding whole texts with the tokenizers library.

A text is cut where no token can reach over, every piece is encoded once, and
the pieces' ids are joined.  It is cut at spaces whose two neighbours are
no white space (the tokenizers' patterns let a space only begin a token), between a letter and a
full stop, comma or the like, and around a single newline.  Arrow makes these cuts for texts without other white
space beside a space, ``learn`` makes those that are left; most pieces are known then.  Of the new ones, plain letters with a space before go
through the library many words at a time (or to its model, where that wants words lower-cased), plain letters without one to its model directly,
all else through its whole pipeline.  No cut falls
into the string of a special token, which the loaded tokenizer gives its one id.  Tests
compare with the library's encoding of whole texts.

Known pieces are kept by the Python worker in two generations of bounded size:
when the young one is full it becomes the old one, and pieces in use return.
Pieces over a line's end are not kept.  Texts go through in lots of at most ``GROUP`` bytes, or one text.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN_PIECES = 250_000
#: new words that are encoded as one text; characters of texts whose pieces are looked up together
TOGETHER, GROUP = 500, 4_000_000
CUT = re.compile(r"(?<=\S)(?= \S)")
BESIDE = re.compile(r" (?:(?=\s)|(?<=\s ))")
#: Letters of ASCII and Latin-1, which every pattern here counts as letters.
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
FINER = re.compile(rf"(?<=[{LETTER}])(?=[,.;:!?])|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
#: The same cuts for Arrow, beside ASCII and Latin-1 only (a cut that is left out here is made in ``learn``).
FINE = [(rf"([{LETTER}])([,.;:!?])", "\\1\0\\2"), (rf"([!-~{LETTER}])\n([!-~{LETTER}])", "\\1\0\n\0\\2")]
PLAIN = re.compile(rf" ?[{LETTER}]+")
PROBES = [" the", "The", "zebra", " Éte", "straße", " naïveté", "ÀÉÎ", " Ünder", "a", " Z"]
_ENCODERS: dict[str, "Encoder"] = {}


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level
    vocabulary: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str, known: int = KNOWN_PIECES):
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.known = known
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # the form in which the model wants a word: as it is, or lower-cased without its space
        self.form = next((f for f in (str, lambda p: p.lstrip(" ").lower())
                          if all(self._model(f(p)) == self._whole([p])[0] for p in PROBES)), None)
        self.begins = self._begins() if self.form is str or self.form is None else None

    def _whole(self, pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _model(self, word: str) -> bytes:
        if not word.isascii() or word[:1] == " ":  # other bytes stand for themselves in words
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _begins(self) -> np.ndarray | None:
        """Which ids begin with a space, where the vocabulary keeps one."""
        space = self.letters[ord(" ")]
        vocab = self.tokenizer.get_vocab()
        out = np.zeros(max(vocab.values(), default=0) + 1, bool)
        out[[i for t, i in vocab.items() if t.startswith(space)]] = True
        return out if out.any() else None

    def _missing(self, pieces) -> list[str]:
        """Pieces that are not known."""
        young = self.young
        return self._not_old([p for p in pieces if p not in young])

    def _not_old(self, pieces: list[str]) -> list[str]:
        """Pieces that the old generation lacks; its own come into the young one."""
        old = self.old
        if not old:
            return pieces
        self.young.update([(p, old[p]) for p in pieces if p in old])
        return [p for p in pieces if p not in old]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain letters that begin with a space: by the model where its form of a word is lower-cased, else
        hundreds of them as one text, where the space begins a word in every pattern here and an id tells whether it begins with one."""
        if self.form is not None and self.begins is None:
            return [self._model(self.form(w)) for w in words]
        if self.begins is None:
            return self._whole(words)
        out = []
        lots = [words[a:a + TOGETHER] for a in range(0, len(words), TOGETHER)]
        for lot, e in zip(lots, self.tokenizer.encode_batch_fast(["".join(lot) for lot in lots], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            first = np.flatnonzero(self.begins[ids])
            if len(first) != len(lot) or first[0]:  # not a word each after all
                out += self._whole(lot)
                continue
            raw, ends = ids.tobytes(), (4 * first).tolist()
            out += [raw[a:b] for a, b in zip(ends, [*ends[1:], len(raw)])]
        return out

    def learn(self, pieces: list[str]) -> None:
        """Ids of pieces that are not known yet."""
        young, plain = self.young, PLAIN.fullmatch
        words, mixed = [], []
        for p in pieces:  # without the pattern where a word is of ASCII
            (words if p[1:].isalpha() and p[1:].isascii() and p[0] == " " or plain(p) else mixed).append(p)
        seen = set(words)
        cut = list(map(FINER.split, mixed))
        parts = self._missing(set().union(*cut) - seen)
        words += [p for p in parts if plain(p)]
        spaced = [p for p in words if p[0] == " "]
        young.update(zip(spaced, self._words(spaced)))
        hard = [p for p in parts if not plain(p)]
        if self.form is not None:
            young.update((p, self._model(self.form(p))) for p in words if p[0] != " ")
        else:
            hard += [p for p in words if p[0] != " "]
        for a in range(0, len(hard), 4096):
            young.update(zip(hard[a:a + 4096], self._whole(hard[a:a + 4096])))
        get = young.__getitem__
        young.update([(p, b"".join(map(get, x))) for p, x in zip(mixed, cut)])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text (null: none)."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size > GROUP:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > self.known:
            self.old, self.young = self.young, {}
        pieces, sizes = split_texts(texts)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        young = self.young
        ids = list(map(young.get, distinct))
        at = [i for i, x in enumerate(ids) if x is None]
        if at:
            new = [distinct[i] for i in at]
            self.learn(self._not_old(new))
            for i, p in zip(at, new):
                ids[i] = young[p]
                if "\n" in p and p != "\n":  # words with a newline between them hardly come again
                    del young[p]
        # the ids of all pieces, one after another
        flat = pa.array(ids, pa.large_binary()).take(coded.indices)
        if not len(flat):
            return [b""] * len(texts)
        _, offsets, data = flat.buffers()
        last = np.frombuffer(offsets, np.int64)[flat.offset:][np.cumsum([0, *sizes])].tolist()
        raw = memoryview(data) if data is not None else memoryview(b"")
        return [bytes(raw[a:b]) for a, b in zip(last, last[1:])]


def split_texts(texts: list[str]) -> tuple[pa.Array, list[int]]:
    """Pieces of all texts, one after another, and how many are of each."""
    plain = [bool(t) and splits_plainly(t) for t in texts]
    cut = [CUT.split(t) if t and not p else [] for t, p in zip(texts, plain)]
    easy = pa.array([t for t, p in zip(texts, plain) if p], pa.string())
    marked = pc.replace_substring(easy, " ", "\0 ")
    for pattern, cut_in in FINE:
        marked = pc.replace_substring_regex(marked, pattern, cut_in)
    lists = pc.split_pattern(marked, "\0")
    counts = iter(pc.list_value_length(lists).to_pylist())
    sizes = [next(counts) if p else len(c) for p, c in zip(plain, cut)]
    flat, parts, at, done = lists.flatten(), [], 0, 0
    for p, c, n in zip(plain, cut, sizes):
        if p:
            at += n
        elif c:
            parts += [flat.slice(done, at - done), pa.array(c, pa.string())]
            done = at
    parts.append(flat.slice(done))
    return pa.concat_arrays(parts), sizes


def lots(texts: pa.Array):
    """(first row, number of rows) of parts that hold no more than ``GROUP`` bytes of text, or one row."""
    end = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a, before = 0, 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(end, before + GROUP, "right")))
        yield a, b - a
        a, before = b, int(end[b - 1])


def splits_plainly(text: str) -> bool:
    """Is every space of the text between two characters that are no white space?"""
    return not (text[:1].isspace() or text[-1:].isspace() or "\0" in text or BESIDE.search(text))


def forget() -> None:
    """Give the memory of known pieces back."""
    from strata.llm.tables import release

    for e in _ENCODERS.values():
        e.young, e.old = {}, {}
    release()


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
