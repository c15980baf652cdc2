"""Subword ids of whole texts by way of words that are encoded once.

Neither tokenizer that the operators use looks across a space with a character other than white space before it: the
byte-level one's rules cut texts there, and no piece of the other has a space after another character (``checked``). A text
is therefore the chain of its units, each a space and what follows up to the next such space. A unit gets a number
when it is first seen; the ids of all new units of a batch are found together, and a text's ids are then gathered from
one flat array by number. The memory of units is bounded: beyond ``max_units`` it starts anew.
"""

from __future__ import annotations

import os
import re

import numpy as np

CUT = re.compile(r"(?<=\S)(?= )")
WIDE = re.compile(r"\s ")
MAX_UNITS = 800_000
JOINED = 1000  # new units in one text for the tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def units_of(text: str) -> list[bytes]:
    """The units of ``text``, which starts with a space, without their first space."""
    if WIDE.search(text):
        return [u[1:].encode("utf-8") for u in CUT.split(text)]
    return text[1:].encode("utf-8").split(b" ")


def checked(pieces: list[str], space: str) -> list[str]:
    """``pieces``, if none has a space after another character; else cutting texts at spaces would be wrong."""
    if any(space in p.lstrip(space) for p in pieces):
        raise ValueError("a piece of the vocabulary reaches across a space")
    return pieces


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library; names of special tokens in a text are text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel as Alphabet

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte_of = dict(zip(_byte_letters(), range(256), strict=True))
        if set(byte_of) != set(Alphabet.alphabet()):
            raise ValueError("not the byte-level alphabet")
        self.size = self.tokenizer.get_vocab_size()
        special = set(self.tokenizer.get_added_tokens_decoder())
        pieces = ["" if i in special else self.tokenizer.id_to_token(i) or "" for i in range(self.size)]
        self.pieces = [bytes(byte_of[c] for c in p) for p in pieces]
        self.opens = np.array([p.startswith(b" ") for p in self.pieces])

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class SpacePiece:
    """A sentencepiece vocabulary that puts a space before each text; texts are given with that space."""

    SPACE = "▁"

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        pieces = checked([self.model.id_to_piece(i) for i in range(self.size)], self.SPACE)
        self.pieces = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i)
                       else p.replace(self.SPACE, " ").encode("utf-8") for i, p in enumerate(pieces)]
        self.opens = np.array([p.startswith(b" ") for p in self.pieces])
        self.alone = [self.model.piece_to_id(self.SPACE)]  # the library puts no space before an empty text

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.model.encode(t[1:], num_threads=1) if t != " " else self.alone for t in texts]


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, others from U+0100 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def _joins(unit: bytes) -> bool:
    """Whether another unit may follow in one text: nothing at the unit's end runs into it, and it has no second space."""
    if unit.isascii():
        return len(unit) > 0 and unit[-1] > 32 and b" " not in unit
    text = unit.decode("utf-8")
    return not text[-1].isspace() and " " not in text and SpacePiece.SPACE not in text


INSIDE = bytes(range(33, 128)) + b"\t\n\r"
BLANK_END = re.compile(rb"[\t\n\r] ")


def _joinable(units: list[bytes]) -> np.ndarray:
    """``_joins`` of each unit; ASCII units are looked at many at a time."""
    out = np.zeros(len(units), bool)
    is_ascii = np.fromiter(map(bytes.isascii, units), bool, len(units))
    for k in np.flatnonzero(~is_ascii):
        out[k] = _joins(units[k])
    own = np.flatnonzero(is_ascii)
    for i in range(0, len(own), JOINED):
        group = own[i:i + JOINED]
        some = [units[k] for k in group]
        text = b" ".join([b"", *some, b""])
        # a space between two units each, none empty, no blank at an end
        if text.translate(None, INSIDE) == b" " * (len(some) + 1) and b"  " not in text and not BLANK_END.search(text):
            out[group] = True
        else:
            out[group] = list(map(_joins, some))
    return out


def unit_ids(encoder: ByteLevel | SpacePiece, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids of each unit, all ids in the units' order); a unit's first space is understood.

    Units without inner space are put into one text, whose ids fall apart where a piece starts with the space."""
    lengths, parts = np.zeros(len(units), np.int64), [None] * len(units)
    joined = _joinable(units)
    plain = np.flatnonzero(joined)
    groups = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
    texts = [(b" " + b" ".join([units[k] for k in g])).decode("utf-8") for g in groups]
    flat = []
    for group, ids in zip(groups, encoder.ids(texts), strict=True):
        ids = np.array(ids, np.int64)
        starts = np.flatnonzero(encoder.opens[ids])
        if len(starts) == len(group) and starts[0] == 0:
            lengths[group] = np.diff(starts, append=len(ids))
            flat.append(ids)
        else:
            joined[group] = False
    alone = np.flatnonzero(~joined)
    for k, ids in zip(alone, encoder.ids([" " + units[k].decode("utf-8") for k in alone]), strict=True):
        lengths[k], parts[k] = len(ids), ids
    out = np.zeros(int(lengths.sum()), np.int64)
    of_joined = np.repeat(joined, lengths)
    if flat:
        out[of_joined] = np.concatenate(flat)
    if len(alone):
        out[~of_joined] = np.concatenate([np.array(parts[k], np.int64) for k in alone])
    return lengths, out


class Interned(dict):
    """unit -> number, in the order of their first look-up; ``new`` are those not yet learnt."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, unit) -> int:
        number = self[unit] = len(self)
        self.new.append(unit)
        return number

    def numbers(self, units: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, units), np.int64, len(units))


class Ragged:
    """Rows of different lengths in one flat array that grows."""

    def __init__(self, dtype) -> None:
        self.flat = np.zeros(1 << 16, dtype)
        self.ends = np.zeros(1 << 12, np.int64)  # of row k: ends[k + 1]
        self.rows = 0

    def extend(self, lengths: np.ndarray, values: np.ndarray) -> None:
        used = self.ends[self.rows]
        if used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat[:used], np.zeros(used + 2 * len(values), self.flat.dtype)])
        self.flat[used:used + len(values)] = values
        if self.rows + len(lengths) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends[:self.rows + 1], np.zeros(self.rows + 2 * len(lengths) + 1, np.int64)])
        self.ends[self.rows + 1:self.rows + len(lengths) + 1] = used + np.cumsum(lengths)
        self.rows += len(lengths)

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        return self.ends[rows + 1] - self.ends[rows]

    def gather(self, rows: np.ndarray) -> np.ndarray:
        """The values of ``rows``, one after the other."""
        n = self.lengths(rows)
        before = np.cumsum(n) - n
        return self.flat[np.repeat(self.ends[rows] - before, n) + np.arange(int(n.sum()))]


MARKS = b".,!?;:"


class TextEncoder:
    """Ids (unsigned 32 bits) of texts by a byte-level vocabulary.

    Final marks after an ASCII letter or digit are cut from it by the vocabulary's rules, so a unit with such marks is made of
    the unit without and the marks. Of the units known before the memory was started anew, those that occur again are taken over."""

    def __init__(self, path: str, max_units: int = MAX_UNITS) -> None:
        self.encoder, self.max_units = ByteLevel(path), max_units
        self.known, self.rows, self.table = Interned(), np.zeros(0, np.int64), Ragged(np.uint32)
        self._start()

    def _start(self) -> None:
        self.older = self.known, self.rows, self.table
        self.known, self.rows, self.table = Interned(), np.zeros(0, np.int64), Ragged(np.uint32)
        self.plain: dict[str, int] = {}  # rows of first words, which have no space, and of marks

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null as empty."""
        if not texts:
            return []
        if len(self.known) > self.max_units // 2:
            self._start()
        firsts, numbers = [], []
        for text in texts:
            first, rest = None, []
            if text and text[0] == " ":
                rest = units_of(text)
            elif text:
                first, *rest = units_of(" " + text)
                first = first.decode("utf-8")
            firsts.append(first)
            numbers.append(self.known.numbers(rest))
        self._learn()
        self._learn_plain({x for x in firsts if x})
        rows = [r for x, own in zip(firsts, numbers, strict=True) for r in ([np.array([self.plain[x]])] if x else []) + [self.rows[own]]]
        flat = np.concatenate(rows)
        ends = np.cumsum(self.table.lengths(flat))
        cuts = np.cumsum([(1 if x else 0) + len(own) for x, own in zip(firsts, numbers, strict=True)])
        return np.split(self.table.gather(flat), np.concatenate([[0], ends])[cuts[:-1]])

    def _add(self, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        first = self.table.rows
        self.table.extend(lengths, ids)
        return np.arange(first, self.table.rows)

    def _learn_plain(self, texts: set[str]) -> None:
        new = [t for t in texts if t not in self.plain]
        ids = self.encoder.ids(new)
        lengths = np.array(list(map(len, ids)), np.int64)
        self.plain.update(zip(new, self._add(lengths, np.array([i for x in ids for i in x], np.uint32)).tolist(), strict=True))

    def _learn(self) -> None:
        known, (older, older_rows, older_table) = self.known, self.older
        base = len(self.rows)
        held = list(map(older.get, known.new))  # their numbers there, or None
        made, stems = [], []
        for k, (unit, number) in enumerate(zip(known.new, held, strict=True)):
            if number is None and len(stem := unit.rstrip(MARKS)) < len(unit) and stem[-1:].isalnum():
                made.append(k)
                stems.append(stem)
        stems = known.numbers(stems)  # the units without their marks are looked up, and so become new themselves
        new, known.new = known.new, []
        held += map(older.get, new[len(held):])
        own = np.zeros(len(new), np.int64)
        held = np.array([-1 if number is None else number for number in held], np.int64)
        taken, of_made = np.flatnonzero(held >= 0), np.array(made, np.int64)
        fresh = held < 0
        fresh[of_made] = False
        fresh = np.flatnonzero(fresh)
        own[fresh] = self._add(*unit_ids(self.encoder, [new[k] for k in fresh]))
        if len(taken):
            rows = older_rows[held[taken]]
            own[taken] = self._add(older_table.lengths(rows), older_table.gather(rows))
        self.rows = np.concatenate([self.rows, own])
        if made:
            marks = [new[k][len(new[k].rstrip(MARKS)):].decode() for k in made]
            self._learn_plain(set(marks))
            rows = np.stack([self.rows[stems], [self.plain[m] for m in marks]], 1).ravel()
            self.rows[base + of_made] = self._add(self.table.lengths(rows).reshape(-1, 2).sum(1), self.table.gather(rows))
