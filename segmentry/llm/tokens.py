"""Token ids of whole texts by the tokenizers library, with repeated pieces encoded once."""

from __future__ import annotations

import re
import sys
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Without U+0130, whose lower case is two characters.
LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
VISIBLE = "!-~À-ɏ"
#: Pieces that can be encoded one by one, as no pre-tokenizer of the byte-level or word-level kind joins
#: anything across their ends: a run of Latin letters before a blank or plain punctuation, with the
#: blank that leads it; or whatever else there is up to a blank between two visible Latin characters.
PIECES = re.compile(f" ?[{LATIN}]+(?=[ ,.;:!?*#$%&|\\n]|\\Z)|[\\s\\S]+?(?=(?<=[{VISIBLE}]) [{VISIBLE}]|\\Z)")
CUT = re.compile(f"(?<=[{VISIBLE}])(?= [{VISIBLE}])")
WORD = re.compile(f" [{LATIN}]+\\Z")
#: First and last characters of a run without blanks that blanks around it cut off from its neighbours.
EDGES = frozenset(chr(k) for k in range(0x250) if re.match(f"[{VISIBLE}]", chr(k)))
#: Code points that are encoded at a time; only bounds memory.
SEGMENT = 1 << 21


def _edges(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the first and the last character of each word are ``VISIBLE``."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int32, len(words) + 1, 4 * words.offset)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    out = []
    for end, place in ((slice(1), at[:-1]), (slice(-1, None), at[1:] - 1)):
        byte = np.zeros(len(words), np.uint8)
        some = at[1:] > at[:-1]
        byte[some] = data[place[some]]
        visible = (byte >= ord("!")) & (byte <= ord("~"))
        wide = np.flatnonzero(byte > 127)  # part of another character than those of ASCII
        visible[wide] = [w[end] in EDGES for w in words.take(wide).to_pylist()]
        out.append(visible)
    return out[0], out[1]


def _joined(words: pa.StringArray) -> str:
    """The words with a blank between them."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(whole, " ")[0].as_py()


class PieceEncoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    The ids of a piece come from the tokenizer and are kept for its next occurrence.  Beyond
    ``max_pieces``, the pieces that were met only once are forgotten, then all.  Strings of
    added tokens in a text become their ids, as the library does by default, unless ``plain``:
    then they are ordinary text.
    """

    def __init__(self, path: str, max_pieces: int = 600_000, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # of pieces, which hold no such strings unless they are plain
        self.added = None
        if not plain:
            strings = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
            # A text that may hold one, whatever the normalizer does to case, is left to the library as a whole.
            self.added = re.compile("|".join(map(re.escape, strings)), re.IGNORECASE) if strings else None
        self.max_pieces = max_pieces
        self.letters = self._letters()
        self._keep([], np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _keep(self, pieces: list[str], flat: np.ndarray, size: np.ndarray) -> None:
        self.slot = dict(zip(pieces, range(len(pieces))))
        self.flat, self.size, self.first = flat, size, np.cumsum(size) - size
        self.met = np.zeros(len(pieces), np.int64)

    def _forget(self) -> None:
        often = self.met > 1
        if often.sum() > self.max_pieces // 2:
            often[:] = False
        flat = self.flat[np.repeat(often, self.size)]
        self._keep(list(compress(self.slot, often)), flat, self.size[often])

    def _letters(self) -> dict[int, str] | None:
        """What the tokenizer turns each Latin letter into; a line break for the blank.  None if not one by one."""
        table = {}
        for c in (chr(k) for k in range(0x250) if re.match(f"[{LATIN}]", chr(k))):
            tokens = self._tokens(c)
            if len(tokens) != 1:
                return None
            table[ord(c)] = tokens[0][0]
        for pair in ("aZ", "éß", "Éz", "ǆa"):
            if self._tokens(pair) != [(pair.translate(table), (0, len(pair)))]:
                return None
        ((self.lead, _),) = self._tokens(" a")
        self.lead = self.lead.removesuffix("a")
        return table | {ord(" "): "\n"}

    def _tokens(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(text)

    def _words(self, words: list[str]) -> tuple[list[int], list[int]]:
        """Ids and their number for pieces that are a blank and a Latin word each."""
        split, ids, size = self.tokenizer.model.tokenize, [], []
        for token in "".join(words).translate(self.letters).split("\n")[1:]:
            own = [t.id for t in split(self.lead + token)]
            size.append(len(own))
            ids += own
        return ids, size

    def _learn(self, pieces: list[str]) -> None:
        plain, rest = [], pieces
        if self.letters:
            rest = []
            for p in pieces:
                (plain if WORD.match(p) else rest).append(p)
        known = self._words(plain)
        ids, size = np.array(known[0], np.uint32), np.array(known[1], np.int64)
        if rest:
            encoded = self.tokenizer.encode(rest, is_pretokenized=True, add_special_tokens=False)
            ids = np.concatenate([ids, np.array(encoded.ids, np.uint32)])
            size = np.concatenate([size, np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(rest))])
        start = len(self.slot)
        self.slot.update(zip(plain + rest, range(start, start + len(pieces))))
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
        self.flat = np.concatenate([self.flat, ids])
        self.size = np.concatenate([self.size, size])
        self.met = np.concatenate([self.met, np.zeros(len(pieces), np.int64)])

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, and where each piece ends among them."""
        if len(self.slot) > self.max_pieces:
            self._forget()
        slots = list(map(self.slot.get, pieces))
        if None in slots:
            self._learn(list(dict.fromkeys(p for p, k in zip(pieces, slots) if k is None)))
            slots = list(map(self.slot.__getitem__, pieces))
        slots = np.array(slots, np.int64)
        self.met += np.bincount(slots, minlength=len(self.met))
        size = self.size[slots]
        ends = np.cumsum(size)
        take = np.repeat(self.first[slots] - ends + size, size)
        take += np.arange(len(take))
        return self.flat[take], ends

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        held: list[str] = []
        chars = 0

        def flush():
            nonlocal held, chars
            if held:
                out.extend(self._together(held))
            held, chars = [], 0

        for text in texts:
            if self.added and self.added.search(text):
                flush()
                out.append(self._as_given(text))
                continue
            if len(text) > SEGMENT:
                flush()
                out.append(self._long(text))
                continue
            held.append(text)
            chars += len(text)
            if chars >= SEGMENT:
                flush()
        flush()
        return out

    def _together(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; what stands between blanks is cut into pieces once for all texts that hold it.

        A text is taken so if all its blanks are ends of pieces, and is cut as a whole if not.
        """
        runs = pc.split_pattern(pa.array(texts, pa.string()), " ")
        offsets = runs.offsets.to_numpy()
        coded = runs.flatten().dictionary_encode()
        code, words = coded.indices.to_numpy(), coded.dictionary
        lead = np.zeros(len(code), bool)
        lead[offsets[:-1]] = True
        head, tail = _edges(words)
        ended = tail[code]
        ended[lead] |= np.equal(pc.binary_length(words).to_numpy(), 0)[code[lead]]  # the blank begins the text
        torn = np.zeros(len(code), bool)  # the blank before the run is no end of a piece
        torn[1:] = ~(ended[:-1] & head[code[1:]])
        torn &= ~lead
        whole = np.logical_or.reduceat(torn, offsets[:-1])
        able = ~np.repeat(whole, np.diff(offsets))

        # Units of pieces: runs that lead a text, runs with their blank that end one openly, texts that are cut as a whole;
        # then the other runs with their blank, which are cut as one text.
        leads, others = np.zeros(len(words), bool), np.zeros(len(words), bool)
        leads[code[lead & able]] = others[code[~lead & able]] = True
        first, last, later = map(np.flatnonzero, (leads, others & ~tail, others & tail))
        units = words.take(first).to_pylist() + [" " + w for w in words.take(last).to_pylist()]
        units += [texts[k] for k in np.flatnonzero(whole).tolist()]
        pieces, ends = [], [0]
        for text in units:
            pieces += PIECES.findall(text)
            ends.append(len(pieces))
        rest = PIECES.findall(" " + _joined(words.take(later))) if len(later) else []
        begins = np.flatnonzero(np.array([p[0] == " " for p in rest], bool)) + len(pieces)
        ids, stops = self._ids(pieces + rest)
        ends = [*ends[:-1], *begins.tolist(), len(stops)] if len(later) else ends
        marks = np.concatenate([[0], stops])[ends]
        start, size = marks[:-1], np.diff(marks)

        unit, of_run = np.zeros(len(words), np.int64), np.zeros(len(code), np.int64)
        unit[first] = np.arange(len(first))
        of_run[lead] = unit[code[lead]]
        of_run[offsets[:-1][whole]] = len(first) + len(last) + np.arange(whole.sum())
        unit[last] = len(first) + np.arange(len(last))
        unit[later] = len(units) + np.arange(len(later))
        of_run[~lead] = unit[code[~lead]]
        size = np.where(able | lead, size[of_run], 0)
        done = np.cumsum(size)
        take = np.repeat(start[of_run] - done + size, size)
        take += np.arange(len(take))
        ids = ids[take]
        marks = np.concatenate([[0], done])[offsets].tolist()
        return [ids[a:b] for a, b in zip(marks[:-1], marks[1:])]

    def _as_given(self, text: str) -> np.ndarray:
        """A text that may hold strings of added tokens."""
        self.tokenizer.encode_special_tokens = False
        try:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        finally:
            self.tokenizer.encode_special_tokens = True

    def _long(self, text: str) -> np.ndarray:
        parts, at = [], 0
        while at < len(text):
            cut = CUT.search(text, at + SEGMENT)
            end = cut.start() if cut else len(text)
            parts.append(self._ids(PIECES.findall(text[at:end]))[0])
            at = end
        return np.concatenate(parts)


def encoder(path: str, plain: bool = False) -> PieceEncoder:
    """The encoder of this worker process; later tasks of the process find the pieces it has kept."""
    kept = sys.__dict__.setdefault("_segmentry_encoders", {})
    if (path, plain) not in kept:
        kept[path, plain] = PieceEncoder(path, plain=plain)
    return kept[path, plain]


def release() -> None:
    """Lets go of the encoders that earlier tasks of this worker process have left, where a task needs none."""
    kept = sys.__dict__.get("_segmentry_encoders")
    if kept:
        kept.clear()
        pa.default_memory_pool().release_unused()
