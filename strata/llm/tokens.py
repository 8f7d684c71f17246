"""Exact byte-level BPE ids of whole texts with a public tokenizer file."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from strata.llm.common import let_go, lists, remembers

TOKENIZER = "byte_bpe_50k.json"
#: White space other than blanks and line ends, and the blanks where a text may be cut.
_RARE = [letter for letter in map(chr, range(0x3001)) if letter.isspace() and letter not in " \n"]
_BLANK = re.compile(r"(?<=\S) (?=\S)")
#: Chunks of more bytes are encoded each time and not remembered.
_LONGEST = 64
#: Chunks encoded together, at most.
_WAITING = 20_000
_ENCODERS: dict[str, Encoder] = {}
remembers("tokens", _ENCODERS.clear)


def tokenizer_path(path: str | None = None) -> str:
    """``path``, or the installed default file on the machine that asks."""
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class Encoder:
    """Encodes texts chunk by chunk, remembering chunks.

    The tokenizer's own splitting never joins across one blank between two characters that are
    not white space, so a text may be cut before each such blank and the ids of the chunks
    joined. Chunks repeat: the different ones of all texts are looked up in an Arrow array of those remembered. The
    library encodes many of the others as one text, which is cut again by the number of bytes that each id stands for. What
    is remembered is bounded by ``limit`` chunks: beyond it, those used most stay. As in the library, added tokens of the
    file are cut out of a text first and have their own ids; a text with one that takes in what is beside it is left to
    the library. A final id ``end`` closes every document.
    """

    def __init__(self, path: str, end: int = 0, limit: int = 300_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.tokenize = self.library.model.tokenize
        added = self.library.get_added_tokens_decoder()
        self.added = {token.content: number for number, token in added.items()}
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.apart = not any(token.single_word or token.lstrip or token.rstrip for token in added.values())
        self.together = not any(" " in content for content in self.added)
        vocabulary = self.library.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = byte_letters()
        self.end, self.limit = end, limit
        self.special = {content: 1 + i for i, content in enumerate(self.added)}
        #: Remembered chunks, each after a blank; their ids, one chunk after another; how many ids and uses each has.
        self.known = pa.array([], pa.string())
        self.pool, self.lengths, self.uses = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.long = False

    def remember(self, chosen: np.ndarray) -> None:
        """Forget all remembered chunks but the ``chosen`` ones."""
        self.known = self.known.filter(pa.array(chosen))
        self.pool = self.pool[np.repeat(chosen, self.lengths)]
        self.lengths, self.uses = self.lengths[chosen], self.uses[chosen]

    def thin(self) -> None:
        """Half of ``limit`` chunks, and ids in proportion, at most stay: those used most, and twice since the last time."""
        order = np.argsort(-self.uses, kind="stable")[:self.limit // 2]
        order = order[(self.uses[order] > 1) & (np.cumsum(self.lengths[order]) <= 4 * self.limit)]
        chosen = np.zeros(len(self.uses), bool)
        chosen[order] = True
        self.remember(chosen)
        self.uses //= 2

    def learn(self, chunks: pa.StringArray) -> None:
        """Encodes new chunks, each after a blank, many as one text, and remembers them."""
        pools, counts = [self.pool], [self.lengths]
        for start in range(0, len(chunks), _WAITING):
            group = chunks.slice(start, _WAITING)
            joined = pc.binary_join(lists(np.array([0, len(group)]), group), " ")[0].as_py()
            ids = np.array(self.library.encode_batch_fast([" " + joined], add_special_tokens=False)[0].ids, np.uint32)
            wanted = np.cumsum(pc.binary_length(group).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            ends = np.cumsum(self.sizes[ids])
            last = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
            if self.together and np.array_equal(ends[last], wanted):
                lengths = np.diff(last, prepend=-1)
            else:
                ids, lengths = self.alone([" " + name for name in group.to_pylist()])
            self.long |= bool(wanted.size and np.diff(wanted, prepend=0).max() > _LONGEST + 1)
            pools.append(ids)
            counts.append(lengths)
        self.known = pa.concat_arrays([self.known, chunks])
        self.pool, self.lengths = np.concatenate(pools), np.concatenate(counts)
        self.uses = np.concatenate([self.uses, np.zeros(len(chunks), np.int64)])

    def alone(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, however long, one after another, and how many each has."""
        ids, lengths = array("I"), np.zeros(len(chunks), np.int64)
        for i, chunk in enumerate(chunks):
            before = len(ids)
            for piece in self.pieces(chunk):
                letters = piece.encode().decode("latin-1").translate(self.letters)
                ids.extend([token.id for token in self.tokenize(letters)])
            lengths[i] = len(ids) - before
        return np.array(ids, np.uint32), lengths

    def regular(self, text: str) -> bool:
        """Whether the text may be cut at all its blanks and has no added token."""
        odd = "  " in text or "\n " in text or " \n" in text or text[0] == " " or text[-1].isspace() or any(
            letter in text for letter in _RARE)  # one search a letter is much faster than one pattern
        return not odd and not any(content in text for content in self.added)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each document starts in them (one more entry than documents)."""
        if len(self.known) > self.limit or len(self.pool) > 8 * self.limit:
            self.thin()
        regular = [i for i, text in enumerate(texts) if text and self.regular(text)]
        cut = pc.split_pattern(pa.array([texts[i] for i in regular], pa.string()), " ")
        bounds, words = np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))).astype(np.int64), cut.values
        # Codes: 0 the end, then the added tokens, then chunks after a blank; below 0 what is encoded by itself.
        fixed = 1 + len(self.special)
        flat = np.arange(fixed, fixed + len(words))
        firsts = words.take(pa.array(bounds[:-1])).to_pylist()
        flat[bounds[:-1]] = -1 - np.arange(len(firsts))
        lone, lone_lengths = self.alone(firsts)
        others = _Others(self, fixed + len(words), len(firsts))
        places = dict(zip(regular, range(len(regular))))
        parts, counts, end = [], [], np.zeros(1, np.int64)
        for i, text in enumerate(texts):
            if i in places:
                parts.append(flat[bounds[places[i]]:bounds[places[i] + 1]])
            else:
                parts.append(np.array(others.codes(text) if text else [], np.int64))
            parts.append(end)
            counts.append(len(parts[-2]) + 1)
        codes = np.concatenate([end[:0], *parts])
        chunks = pa.concat_arrays([words, pa.array(others.after, pa.string())]).dictionary_encode()
        rows = fixed + self.rows_of(chunks)
        lengths = np.concatenate([np.ones(fixed, np.int64), self.lengths, lone_lengths, np.array(list(map(len, others.ids)), np.int64)])
        pool = np.concatenate([np.array([self.end, *self.added.values()], np.uint32), self.pool, lone, *others.ids])
        rows = np.where(codes < 0, fixed + len(self.known) - 1 - codes, np.append(np.arange(fixed), rows)[np.maximum(codes, 0)])
        starts, lengths = (np.cumsum(lengths) - lengths)[rows], lengths[rows]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)
        if self.long:
            self.long = False
            self.remember(pc.binary_length(self.known).to_numpy(zero_copy_only=False) <= _LONGEST)
        return pool[at], np.append(0, ends[np.cumsum(counts, dtype=np.int64) - 1]).astype(np.int64) if counts else np.zeros(1, np.int64)

    def rows_of(self, chunks: pa.DictionaryArray) -> np.ndarray:
        """The place of every chunk among the remembered ones, which new ones join."""
        found = pc.index_in(chunks.dictionary, value_set=self.known)
        new = chunks.dictionary.filter(pc.is_null(found))
        places = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        places[places < 0] = len(self.known) + np.arange(len(new))
        self.learn(new)
        indices = chunks.indices.to_numpy(zero_copy_only=False)
        self.uses[places] += np.bincount(indices, minlength=len(places))
        return places[indices]


class _Others:
    """Codes of texts that may not be cut at all their blanks or have added tokens."""

    def __init__(self, encoder: Encoder, code: int, lone: int):
        self.encoder, self.code, self.lone = encoder, code, lone
        self.after: list[str] = []
        self.ids: list[np.ndarray] = []

    def by_itself(self, ids: np.ndarray) -> int:
        self.ids.append(ids)
        return -self.lone - len(self.ids)

    def codes(self, text: str) -> list[int]:
        encoder = self.encoder
        if not any(content in text for content in encoder.added):
            return self.plain_codes(text)
        if not encoder.apart:
            return [self.by_itself(np.array(encoder.library.encode(text, add_special_tokens=False).ids, np.uint32))]
        codes = []
        for i, part in enumerate(encoder.at_added.split(text)):
            codes.extend([encoder.special[part]] if i % 2 else self.plain_codes(part) if part else [])
        return codes

    def plain_codes(self, text: str) -> list[int]:
        first, *rest = _BLANK.split(text)
        codes = [self.by_itself(self.encoder.alone([first])[0])]
        last = [self.by_itself(self.encoder.alone([" " + rest.pop()])[0])] if rest and rest[-1][-1].isspace() else []
        codes.extend(range(self.code + len(self.after), self.code + len(self.after) + len(rest)))
        self.after.extend(rest)
        return codes + last


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the rest follow from 256 on, in byte order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


def encoder(path: str | None = None, end: int = 0) -> Encoder:
    """One encoder for a worker process, so that what it remembers serves later tasks too."""
    let_go("tokens")
    key = f"{end}:{tokenizer_path(path)}"
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(tokenizer_path(path), end)
    return _ENCODERS[key]
