"""Token ids of whole texts from the installed tokenizers, for Arrow tasks.

A text is cut at places where no token can cross: before or after white space, as the
tokenizer's own first split does. Equal pieces have equal ids, so a batch's distinct pieces
are found by dictionary encoding, a worker keeps the ids of the pieces it has met (at most
``max_entries`` of them) and asks the tokenizer only for new ones. Texts of tokenizers with
another first split are encoded whole.
"""

from __future__ import annotations

import array
import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space as the tokenizers' own patterns take it (Unicode property White_Space).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Pieces of a tokenizer that joins one space to the word after it.
JOINED = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Texts in which single spaces (one may come first) and line ends between words are not the
#: only white space.
ODD = (
    r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
    r"|^\n|^ $|[\n ]$|[\t\x0b-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[\x01\x02]"
)
#: Pieces in one call of the tokenizer.
ASKED = 2000
#: A letter or digit, one point or comma, white space: the mark is a token of its own.
MARKED = r"([\p{L}\p{N}])([.,])([ \n]|$)"
#: Characters beyond Latin letters: composed forms may depend on the case.
BEYOND_LATIN = r"[^\x{0}-\x{24f}]"


def _first_split(spec: dict) -> str:
    split = spec.get("pre_tokenizer") or {}
    if split.get("type") == "ByteLevel":
        plain = split.get("use_regex", True) and not split.get("add_prefix_space") and not spec.get("normalizer")
        return "joined" if plain else "none"
    for part in split.get("pretokenizers", []):
        if part.get("type") == "Split" and part.get("behavior") == "Removed" and part.get("invert"):
            return "dropped"
    return "none"


class PieceEncoder:
    """Ids of texts, as arrays of ``dtype``."""

    def __init__(self, path: str, max_entries: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._split = _first_split(spec)
        added = [x for x in spec.get("added_tokens", [])]
        self._marks = [x["content"] for x in added]
        plain = [x for x in added if not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"])]
        self._stop = plain[0]["content"] if plain else None
        self._stop_id = plain[0]["id"] if plain else -1
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._lowers = self._split == "dropped" and any(
            x.get("type") == "Lowercase" for x in (spec.get("normalizer") or {}).get("normalizers", [])
        )
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._known: dict[str, bytes] = {}
        self._max_entries = max_entries
        # a line end before a word is a piece of its own to the tokenizer
        self._line_end = self._ask(["\n"])[0] if self._split == "joined" else b""

    def _ask(self, texts: list[str]) -> list[bytes]:
        """Each text on its own; added tokens' strings in a text are ordinary text."""
        self._tokenizer.encode_special_tokens = True
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array.array(self._code, x.ids).tobytes() for x in found]

    def _ask_joined(self, texts: list[str]) -> list[bytes]:
        """Several texts in one call, parted by an added token, which splits before
        anything else: less work for each."""
        if self._stop is None or any(m in x for m in self._marks for x in texts):
            return self._ask(texts)
        self._tokenizer.encode_special_tokens = False
        ids = np.array(self._tokenizer.encode_batch_fast([self._stop.join(texts)], add_special_tokens=False)[0].ids, self.dtype)
        stops = np.flatnonzero(ids == self._stop_id)
        firsts, lasts = np.append(0, stops + 1).tolist(), np.append(stops, len(ids)).tolist()
        raw, width = ids.tobytes(), self.dtype.itemsize
        out = [raw[a * width : b * width] for a, b in zip(firsts, lasts, strict=True)]
        return out if len(out) == len(texts) else self._ask(texts)

    def _values(self, pieces: list[str]) -> list[bytes]:
        known = self._known
        if len(known) + len(pieces) > self._max_entries:
            known.clear()
        new = list(set(pieces).difference(known))
        if self._split != "none":
            # letters alone are one piece to the model, which then need not be split
            tokenize, code = self._tokenizer.model.tokenize, self._code
            lead, more = ("", []) if self._split == "dropped" else ("\u0120", [])
            for x in new:
                first = x[:1] if lead else ""
                core = x[1:] if first == " " or first == "\n" else x
                if core.isascii() and core.isalpha() and not (self._split == "dropped" and not core.islower()):
                    asked = lead + core if first == " " else core
                    ids = array.array(code, [t.id for t in tokenize(asked)]).tobytes()
                    known[x] = self._line_end + ids if first == "\n" else ids
                else:
                    more.append(x)
            new = more
        for at in range(0, len(new), ASKED):
            part = new[at : at + ASKED]
            known.update(zip(part, self._ask_joined(part), strict=True))
        return list(map(known.__getitem__, pieces))

    def _coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Piece codes of all texts in a row, offsets of the texts, each code's ids."""
        n = len(texts)
        if self._split == "none":
            return np.arange(n), np.arange(n + 1), self._ask(texts.to_pylist())
        line_end, mark = (" ", r"\1 \2\3") if self._split == "dropped" else (" \x01", "\\1 \x02\\2\\3")
        odd = np.zeros(n, bool)
        if self._split == "joined":
            odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        if self._lowers:
            texts = pc.if_else(pc.match_substring_regex(texts, BEYOND_LATIN), texts, pc.ascii_lower(texts))
        even = texts.filter(pa.array(~odd)) if odd.any() else texts
        even = pc.replace_substring_regex(even, MARKED, mark)
        lists = pc.split_pattern(pc.replace_substring(even, "\n", line_end), " ")
        offsets, coded = lists.offsets.to_numpy().astype(np.int64), lists.flatten().dictionary_encode()
        # through numpy: a list straight from Arrow makes a scalar object for each piece first
        codes, pieces = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        offsets = offsets - offsets[0]
        if self._split == "dropped":
            return codes, offsets, self._values(pieces)
        # the first piece of a text has no space before it; \x01 stands for a line end, \x02
        # for no space
        firsts = offsets[:-1][np.diff(offsets) > 0]
        plain = [pieces[i] for i in codes[firsts].tolist()]
        codes[firsts] = np.arange(len(plain)) + len(pieces)
        lead = {"\x01": "\n", "\x02": ""}
        pieces = [lead[x[0]] + x[1:] if x[:1] in lead else " " + x for x in pieces] + plain
        if odd.any():
            found = [JOINED.findall(x) for x in texts.filter(pa.array(odd)).to_pylist()]
            sizes = np.zeros(n, np.int64)
            sizes[~odd], sizes[odd] = np.diff(offsets), [len(x) for x in found]
            ends = np.append(0, np.cumsum(sizes))
            out = np.empty(ends[-1], np.int64)
            of_odd = np.repeat(odd, sizes)
            out[~of_odd] = codes
            out[of_odd] = np.arange(of_odd.sum()) + len(pieces)
            pieces += [p for x in found for p in x]
            codes, offsets = out, ends
        return codes, offsets, self._values(pieces)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the offsets of the texts among them."""
        codes, offsets, values = self._coded(texts)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(values), self.dtype)
        starts = np.cumsum(sizes) - sizes
        size = sizes[codes]
        ends = np.append(0, np.cumsum(size))
        place = np.repeat(starts[codes] - ends[:-1], size) + np.arange(ends[-1])
        return flat[place], ends[offsets]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        codes, offsets, values = self._coded(texts)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        return np.diff(np.append(0, np.cumsum(sizes[codes]))[offsets])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One per worker process and tokenizer file; kept between tasks."""
    return PieceEncoder(path)


def parts(texts: pa.Array, most: int = 3_000_000):
    """(first, last) row ranges of at most ``most`` bytes, or of one text."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield first, at
            first, held = at, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)
