"""Token ids of whole texts, with the words seen before kept in a table.

Both tokenizers used here cut a text before white space that follows a visible character, whatever
stands around it, and between letters and a closing mark. So a text is split there, each distinct
piece is encoded once by the ``tokenizers`` library, and the ids of the pieces are put together.
Texts in which those rules may not hold (doubled or rarer white space, special-token markers) are
encoded whole by the library.
"""

from __future__ import annotations

import os
import re
import sys
import threading
import time
import types
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import give_back

# What a text holds that has to be encoded whole: white space other than single spaces and line
# breaks between words, and special-token markers. Each is one search for a fixed string.
_WHOLE = (
    "  ", " \n", "\n ", "\n\n", "<|", *map(chr, (
        0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E),
        0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF,
    )),
)
_LETTERS = re.compile("\\n?[A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u00ff]+| [A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u00ff]+")
_MARKS = ".,;:!?#$%&*"
_LOT = 4 << 20  # characters of texts split at once
IDLE = 3.0  # seconds without texts after which a worker's encoder goes


class TokenIds:
    """Encodes texts with a tokenizer file; at most ``keep`` distinct pieces are remembered."""

    def __init__(self, path: str, keep: int = 1_200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use every core
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # Of a byte-level tokenizer: the ids that begin with a space or a line break. A space is a byte
        # of its own there, so every piece has one such id, its first.
        self._opens: np.ndarray | None = None
        if isinstance(self._tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) and self._tokenizer.normalizer is None:
            vocab = self._tokenizer.get_vocab(with_added_tokens=True)
            self._opens = np.zeros(max(vocab.values()) + 1, bool)
            self._opens[[k for token, k in vocab.items() if token[0] in "\u0120\u010a"]] = True
        # Of a tokenizer with a suffix for words' ends: the ids that end a word.
        self._closes: np.ndarray | None = None
        if suffix := getattr(self._tokenizer.model, "end_of_word_suffix", None):
            vocab = self._tokenizer.get_vocab(with_added_tokens=True)
            self._closes = np.zeros(max(vocab.values()) + 1, bool)
            self._closes[[k for token, k in vocab.items() if token.endswith(suffix)]] = True
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._keep = keep
        self._calls = 0  # under way
        self._used = time.monotonic()

    def idle(self) -> float:
        """Seconds since the last call; none while one is under way."""
        return 0.0 if self._calls else time.monotonic() - self._used

    def _encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for begin in range(0, len(texts), 5_000):
            got = self._tokenizer.encode_batch_fast(texts[begin : begin + 5_000], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in got]
        return out

    def _encode_spaced(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that begin with white space, many at a time as one text.

        The tokenizers cut before each, so a token belongs to the piece in which it begins.
        """
        if self._closes is None:
            return self._encode_offsets(pieces)
        words, other = [], []
        for p in pieces:
            (words if _LETTERS.fullmatch(p) else other).append(p)
        ids = dict(zip(words, self._encode_words(words), strict=True))
        ids.update(zip(other, self._encode_offsets(other), strict=True))
        return [ids[p] for p in pieces]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of pieces of white space and letters, each of which one id of a word's end closes.

        Without offsets, which cost more. A run whose ends do not come out even is encoded with them.
        """
        out = []
        for begin in range(0, len(words), 5_000):
            runs = [words[k : k + 250] for k in range(begin, min(begin + 5_000, len(words)), 250)]
            for run, got in zip(runs, self._tokenizer.encode_batch_fast(["".join(r) for r in runs], add_special_tokens=False), strict=True):
                ids = array("I", got.ids)
                ends = np.flatnonzero(self._closes[np.frombuffer(ids, np.uint32)]) + 1
                if len(ends) != len(run) or ends[-1] != len(ids):
                    out += self._encode_offsets(run)
                    continue
                ids, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
                out += [ids[lo:hi] for lo, hi in zip(bounds, bounds[1:])]
        return out

    def _encode_offsets(self, pieces: list[str]) -> list[bytes]:
        runs = [pieces[k : k + 250] for k in range(0, len(pieces), 250)]
        out = []
        for begin in range(0, len(runs), 20):
            some = runs[begin : begin + 20]
            encode = self._tokenizer.encode_batch if self._opens is None else self._tokenizer.encode_batch_fast
            for run, got in zip(some, encode(["".join(r) for r in some], add_special_tokens=False), strict=True):
                ids = array("I", got.ids)
                if self._opens is None:
                    at = np.array([x for x, _ in got.offsets], np.int64)
                    first = np.searchsorted(at, np.cumsum([0, *map(len, run)])[:-1])
                else:
                    first = np.flatnonzero(self._opens[np.frombuffer(ids, np.uint32)])
                    if len(first) != len(run):
                        raise RuntimeError("a piece of text has not just one id that begins with white space")
                ids, bounds = ids.tobytes(), [*(4 * first).tolist(), 4 * len(ids)]
                out += [ids[lo:hi] for lo, hi in zip(bounds, bounds[1:])]
        return out

    def _learn(self, new: set[str]) -> None:
        """Remember the ids of pieces not known. Those known before the table was last full come
        back from the older table, so words in use are not encoded again."""
        if len(self._known) + len(new) > self._keep // 2:
            self._older, self._known = self._known, {}
        known, older = self._known, self._older
        marked: list[str] = []
        words: list[str] = []
        marks: list[str] = []
        plain: set[str] = set()
        for p in new:
            if (ids := older.get(p)) is not None:
                known[p] = ids
                continue
            # A word and closing marks are two pieces: "word", and the marks as a text's beginning.
            word = p.rstrip(_MARKS) if p[-1] in _MARKS else p
            if len(word) < len(p) and _LETTERS.fullmatch(word):
                marked.append(p)
                words.append(word)
                marks.append(" " + p[len(word) :])
            else:
                plain.add(p)
        for p in {*words, *marks}:
            if p not in known:
                if (ids := older.get(p)) is not None:
                    known[p] = ids
                else:
                    plain.add(p)
        spaced = [p for p in plain if p[0] != " "]
        known.update(zip(spaced, self._encode_spaced([p if p[0] == "\n" else " " + p for p in spaced]), strict=True))
        other = [p for p in plain if p[0] == " "]
        known.update(zip(other, self._encode([p[1:] for p in other]), strict=True))
        known.update((p, known[w] + known[m]) for p, w, m in zip(marked, words, marks, strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Unsigned 32-bit ids of each text in the machine's byte order (little-endian here)."""
        self._calls += 1
        try:
            whole = [_is_whole(t) for t in texts]
            rest = iter(self._encode([t for t, w in zip(texts, whole, strict=True) if w]))
            split = iter(self._encode_split([t for t, w in zip(texts, whole, strict=True) if not w]))
            return [next(rest if w else split) for w in whole]
        finally:
            self._used = time.monotonic()
            self._calls -= 1

    def _encode_split(self, texts: list[str]) -> list[bytes]:
        out, lot, size = [], [], 0
        for t in texts:
            lot.append(t)
            size += len(t)
            if size >= _LOT:
                out += self._encode_lot(lot)
                lot, size = [], 0
        return out + self._encode_lot(lot) if lot else out

    def _encode_lot(self, texts: list[str]) -> list[bytes]:
        """Each distinct piece is looked up once; numpy puts the ids together by piece numbers."""
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        bounds, numbered = split.offsets.to_numpy(), split.values.dictionary_encode()
        # By way of numpy: ``to_pylist`` takes four times as long.
        keys, number = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy().astype(np.int64)
        begins = [" " + keys[k] for k in number[bounds[:-1]].tolist()]
        number[bounds[:-1]] = np.arange(len(keys), len(keys) + len(begins))
        keys += begins
        found = list(map(self._known.get, keys))
        new = [k for k, ids in enumerate(found) if ids is None]
        if new:
            # The table may change here: what was found stays found, the rest is now known.
            # A word that only begins texts is looked up without need, as a word after a space.
            self._learn({keys[k] for k in new if keys[k]})
            for k in new:
                found[k] = self._known[keys[k]] if keys[k] else b""
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), np.uint32)
        first, length = (np.cumsum(length) - length)[number], length[number]
        ends = np.cumsum(length)
        at = np.repeat(first - (ends - length), length)
        at += np.arange(len(at))
        put, cuts = ids[at].tobytes(), (4 * np.concatenate([[0], ends])[bounds]).tolist()
        return [put[lo:hi] for lo, hi in zip(cuts, cuts[1:])]


# Pieces as keys: "a b\nc" has the pieces " a", "b" and "\nc", so that splitting at spaces gives the
# keys. A key with a space in front stands for a text's beginning, one without for a space and a word.


def _is_whole(text: str) -> bool:
    return any(x in text for x in _WHOLE) or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n")


def token_ids(path: str) -> TokenIds:
    """This process's encoder of a file: a Python worker serves many tasks and keeps what it knows.

    A worker lives on after the stage, beside other stages. There the encoder and its table of some
    200 MB would lie idle, so they go after ``IDLE`` seconds without a text; a task that still holds
    the encoder goes on with it.
    """
    if sys.byteorder != "little":
        raise RuntimeError("ids are written in little-endian order")
    box = sys.modules.setdefault("_token_ids_of_this_worker", types.ModuleType("_token_ids_of_this_worker")).__dict__
    encoder = box.get(path)
    if encoder is None:
        encoder = box[path] = TokenIds(path)
        threading.Thread(target=_forget, args=(box, path, IDLE), daemon=True).start()
    return encoder


def _forget(box: dict, path: str, idle: float) -> None:
    while path in box and box[path].idle() < idle:
        time.sleep(idle / 4)
    box.pop(path, None)
    give_back()
