"""Merge-type piece encoding by a table over prefixes, and decoding.

For every prefix of a segment the last token of the prefix's encoding is unique. The table holds it: an automaton
gives the pieces that end at each place, and the one is kept whose predecessor, the last token of the prefix in front
of it, stays beside it, that is, whose pair the merges leave as it is. The ids are read backwards from the last entry.

No piece spans a change from another character to the space mark, nor a line feed, so a text is cut at spaces and in
front of line feeds, and segments that occur again come from a bounded cache.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import ahocorasick

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_CACHED_SEGMENTS, _CACHED_LENGTH, _CACHED_PAIRS = 300_000, 48, 500_000
#: Runs where the cut at single spaces does not hold.
_RUNS = re.compile(f"  |{MARK}")
#: What follows a segment's last letter or digit.
_TAIL = re.compile(r"(?<=\w)[^\w ]+$")
_SEGMENTS = re.compile("\n?(?: +[^ \n]*|[^ \n]+)|\n")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbered fields of one protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {2: None, 5: 4, 1: 8}[key & 7] or number()
            yield key >> 3, data[at : at + size]
            at += size


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id."""
    with open(path, "rb") as file:
        entries = [dict(_fields(value)) for field, value in _fields(file.read()) if field == 1]
    return [(e[1].decode(), struct.unpack("<f", e.get(2, b"\0\0\0\0"))[0], e.get(3, NORMAL)) for e in entries]


class PieceModel:
    def __init__(self, path: str):
        self.pieces = read_pieces(path)
        kinds = {kind for _, _, kind in self.pieces}
        if USER in kinds or UNUSED in kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        normal = [(piece, score, i) for i, (piece, score, kind) in enumerate(self.pieces) if kind == NORMAL]
        if any("\n" in piece or MARK in piece.lstrip(MARK) for piece, _, _ in normal):
            raise ValueError("a piece spans the end of a word; the cut at spaces does not hold for this model")
        self.ids = {piece: i for piece, _, i in normal}
        self.scores = {piece: score for piece, score, _ in normal}
        self.bytes = {int(piece[3:5], 16): i for i, (piece, _, kind) in enumerate(self.pieces) if kind == BYTE}
        #: How each piece that merges arrive at is made: its two parts. Other pieces never occur in an encoding.
        self.parts: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, _, number in normal:
            parts = self._merged(piece, whole=False)
            if len(piece) == 1 or (len(parts) == 2 and "".join(parts) == piece):
                self.automaton.add_word(piece, (piece, len(piece), {}, number))
                if len(piece) > 1:
                    self.parts[piece] = (parts[0], parts[1])
        self.automaton.make_automaton()
        self.pairs = 0  # remembered in the third place of the automaton's values, by the token on the left
        #: Characters that stand side by side in some piece; a text may be cut between any others.
        self.beside = {piece[k : k + 2] for piece, _, _ in normal for k in range(len(piece) - 1)}
        self.numbers = {piece: str(i) for piece, i in self.ids.items()}
        self.shown = {piece: piece.replace(MARK, " ") for piece in self.ids}
        self.cache: dict[str, tuple[str, str, int]] = {}

    def _merged(self, text: str, whole: bool = True) -> list[str]:
        """A short text after all merges: always the best-scored pair, of equal ones the leftmost. Without
        ``whole`` the last two symbols are not merged."""
        symbols, scores = list(text), self.scores
        while len(symbols) > (1 if whole else 2):
            best, at = None, -1
            for k in range(len(symbols) - 1):
                score = scores.get(symbols[k] + symbols[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def stays(self, left: str, right: str) -> bool:
        """Whether the merges leave exactly ``left`` and ``right`` of the two written side by side.

        Takes the two apart again, the later made first, and asks at each step whether what then met at the
        boundary would have been merged before what was made instead. Of equal scores the left one is
        merged first. Runs of the mark, whose pieces all have one score, are merged in full.
        """
        if right == MARK or left[-1:] == MARK and right[:1] == MARK:
            return self._merged(left + right) == [left, right]
        scores, parts = self.scores, self.parts
        limit, equal_too = -float("inf"), True  # a pair at the boundary merges if it scores above (or as) this
        while True:
            score = scores.get(left + right)
            if score is not None and (score > limit or (equal_too and score == limit)):
                return False
            of_left, of_right = parts.get(left), parts.get(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and scores[left] < scores[right]):
                limit, equal_too, left = scores[left], False, of_left[1]
            else:
                limit, equal_too, right = scores[right], True, of_right[0]

    def _pair(self, left: str, right: str, known: dict[str, bool]) -> bool:
        """``stays``, remembered in ``known``. With nothing on the left, or a character that is no piece, any
        token stays."""
        if self.pairs >= _CACHED_PAIRS:
            for _, _, remembered, _ in self.automaton.values():
                remembered.clear()
            self.pairs = 0
        self.pairs += 1
        known[left] = not left or self.stays(left, right)
        return known[left]

    def tokens(self, segment: str) -> list[str]:
        """The tokens of a segment in which spaces are marks already; characters that are no piece are tokens too."""
        size = len(segment)
        last: list[str | None] = [None] * size
        for end, (piece, length, known, _) in self.automaton.iter(segment):
            if last[end] is not None:
                continue
            before = end - length
            # Nothing in front, or a character that is no piece: nothing merges with it.
            left = (last[before] or "") if before >= 0 else ""
            fits = known.get(left)
            if fits or (fits is None and self._pair(left, piece, known)):
                last[end] = piece
        out, at = [], size - 1
        while at >= 0:
            token = last[at] or segment[at]
            out.append(token)
            at -= len(token)
        return out[::-1]

    def token_ids(self, tokens: list[str]) -> list[int]:
        out = []
        for token in tokens:
            known = self.ids.get(token)
            if known is not None:
                out.append(known)
            else:
                out += [self.bytes[b] for b in token.encode()]
        return out

    def piece_text(self, ids: list[int]) -> str:
        """The characters of ids, with marks as spaces, runs of byte pieces read as UTF-8."""
        out, run = [], bytearray()
        for i in ids:
            piece, _, kind = self.pieces[i]
            if kind == BYTE:
                run.append(int(piece[3:5], 16))
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            if kind == NORMAL:
                out.append(piece.replace(MARK, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding puts in front goes."""
        return self.piece_text(ids).removeprefix(" ")

    def _new(self, segment: str) -> tuple[str, str, int]:
        cut = _TAIL.search(segment)
        if cut and segment[cut.start() - 1 : cut.start() + 1] not in self.beside:
            entries = [self.cache.get(part) or self._entry(part) for part in (segment[: cut.start()], cut[0])]
            entry = f"{entries[0][0]},{entries[1][0]}", entries[0][1] + entries[1][1], entries[0][2] + entries[1][2]
            return self._remember(segment, entry)
        return self._entry(segment)

    def _entry(self, segment: str) -> tuple[str, str, int]:
        tokens = self.tokens(segment.replace(" ", MARK))
        try:  # the ids of pieces, and the texts of these ids
            entry = ",".join([self.numbers[t] for t in tokens]), "".join([self.shown[t] for t in tokens]), len(tokens)
        except KeyError:  # with characters that become bytes
            ids = self.token_ids(tokens)
            entry = ",".join(map(str, ids)), self.piece_text(ids), len(ids)
        return self._remember(segment, entry)

    def _remember(self, segment: str, entry: tuple[str, str, int]) -> tuple[str, str, int]:
        if len(segment) <= _CACHED_LENGTH:
            if len(self.cache) >= _CACHED_SEGMENTS:
                self.cache.clear()
            self.cache[segment] = entry
        return entry

    def segments(self, text: str) -> list[str]:
        """The text, with a space put in front, cut where no piece spans."""
        text = " " + text.replace(MARK, " ")
        if "  " not in text:
            # Each part follows a space that is the mark of its word, but for those that begin with a line feed.
            parts = text.replace("\n", " \n").split(" ")[1:]
            return [part if part[:1] == "\n" else " " + part for part in parts]
        return _SEGMENTS.findall(text)

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.encode_text(text)[0].split(",") if i]

    def encode_text(self, text: str) -> tuple[str, str, int]:
        """Ids as decimal numbers joined by commas, the text decoded from them, and their number."""
        if not text:
            return "", "", 0
        segments = self.segments(text)
        found = list(map(self.cache.get, segments))
        if None in found:
            found = [entry or self.cache.get(segment) or self._new(segment) for segment, entry in zip(segments, found)]
        ids, texts, counts = zip(*found)
        return ",".join(ids), "".join(texts).removeprefix(" "), sum(counts)


_loaded: dict[str, PieceModel] = {}


def loaded(path: str) -> PieceModel:
    """One model for each worker process."""
    if path not in _loaded:
        _loaded[path] = PieceModel(path)
    return _loaded[path]
