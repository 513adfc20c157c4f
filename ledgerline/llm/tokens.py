"""Token ids of whole texts, with every distinct unit of a word encoded once per worker process.

The tokenizer's own steps never look across ASCII white space: its normalisers work on single
characters and combining marks, and its split pattern leaves white space out of every piece. So the
ids of a text are those of its words in turn. No piece of that pattern holds a Latin letter before an ASCII mark
either, so words are cut there into units, and capitals that the normalisers would put in lower case alone
are put so first. A unit met before need not be encoded again, be it a whole word, begin a sentence or stand before a comma. It is
found by its hash and then compared byte by byte; one whose hash belongs to another unit is encoded by itself.
``tests/llm/test_tokens.py`` holds this against encoding whole texts.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm.arrow import text_bytes
from ledgerline.llm.words import Words, same_blocks

#: Distinct words a worker remembers; beyond, it forgets those not met again. About 70 bytes each.
REMEMBERED = 250_000
#: As many where nothing else needs the worker's memory: rare words come back after long stretches.
REMEMBERED_ALONE = 1_000_000

#: Units that are one piece each, which the tokenizer's own splitter need not find: Latin letters, all of which
#: the normalisers only put in lower case.
_PLAIN = "^[a-zÀ-ÖØ-öø-ÿ]+$"

_CAPITAL, _MARK, _LETTER = np.zeros((3, 256), bool)
_CAPITAL[65:91] = True
_MARK[33:127] = True
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: The first byte of À to ÿ; of their second bytes, those of × and ÷ are no letter's.
_LATIN, _NO_LETTERS = 0xC3, (0x97, 0xB7)


def units(data: np.ndarray, bounds: np.ndarray, added: re.Pattern | None = None) -> tuple[np.ndarray, Words]:
    """The bytes of texts with ASCII capitals in lower case, and their words, cut before an ASCII mark that follows a
    Latin letter. A capital before a character beyond U+00FF, which may combine with it, stays; so does
    what ``added`` finds, whole."""
    after = np.append(data[1:], np.uint8(0))
    capital = _CAPITAL[data] & (after <= _LATIN)
    marks = np.flatnonzero(_MARK[after[:-1]]) + 1
    before = data[marks - 1]
    letter = _LETTER[before]
    latin = np.flatnonzero((before >= 0x80) & (before < 0xC0) & (marks > 1))
    letter[latin] = (data[marks[latin] - 2] == _LATIN) & ~np.isin(before[latin], _NO_LETTERS)
    apart = marks[letter]
    if added is not None:
        stays = np.zeros(len(data), bool)
        for found in added.finditer(data):
            capital[found.start() : found.end()] = False
            stays[found.start() + 1 : found.end()] = True
        apart = apart[~stays[apart]]
    lower = data + capital.astype(np.uint8) * np.uint8(32)
    return lower, Words(lower, bounds, apart=apart)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable bytes stand for themselves,
    the others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in own else next(rest)) for b in range(256)}


_BYTE_LETTERS = _byte_letters()


def _by_bytes(text: str) -> str:
    return text.encode().decode("latin-1").translate(_BYTE_LETTERS)


_loaded: dict[tuple[str, int], "Encoder"] = {}


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _spread(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of stretches that start at ``at`` and have these sizes, end to end."""
    return np.arange(int(size.sum())) + np.repeat(at - (np.cumsum(size) - size), size)


def _flat(encodings: list) -> tuple[np.ndarray, np.ndarray]:
    """The ids of what the tokenizer encoded, end to end, and how many each has."""
    made = [e.ids for e in encodings]
    size = np.fromiter(map(len, made), np.int64, len(made))
    return np.fromiter(chain.from_iterable(made), np.uint32, int(size.sum())), size


class Memory:
    """Words by hash, in order, with their ids and their bytes. ``met``: which were looked up."""

    def __init__(self, keys=None, ids=None, size=None, blocks=None, length=None, met=None):
        empty = np.zeros(0, np.int64)
        self.keys = np.zeros(0, np.uint64) if keys is None else keys
        self.ids = np.zeros(0, np.uint32) if ids is None else ids
        self.size = empty if size is None else size
        self.blocks = np.zeros(0, np.uint64) if blocks is None else blocks
        self.length = empty if length is None else length
        self.met = np.zeros(len(self.keys), bool) if met is None else met
        self.at = np.cumsum(self.size) - self.size
        n_blocks = -(-self.length // 8)
        self.first_block = np.cumsum(n_blocks) - n_blocks

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those not here."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, place, -1)

    def joined(self, other: "Memory") -> "Memory":
        """Both, which have no key in common."""
        keys = np.concatenate([self.keys, other.keys])
        order = np.argsort(keys, kind="stable")
        size, length = (
            np.concatenate([getattr(self, n), getattr(other, n)])[order] for n in ("size", "length")
        )
        at = np.concatenate([self.at, other.at + len(self.ids)])[order]
        first = np.concatenate([self.first_block, other.first_block + len(self.blocks)])[order]
        ids = np.concatenate([self.ids, other.ids])[_spread(at, size)]
        blocks = np.concatenate([self.blocks, other.blocks])[_spread(first, -(-length // 8))]
        met = np.concatenate([self.met, other.met])[order]
        return Memory(keys[order], ids, size, blocks, length, met)

    def of_met(self) -> "Memory":
        """The words that were looked up, which have to be looked up again to stay once more."""
        at = np.flatnonzero(self.met)
        ids = self.ids[_spread(self.at[at], self.size[at])]
        blocks = self.blocks[_spread(self.first_block[at], -(-self.length[at] // 8))]
        return Memory(self.keys[at], ids, self.size[at], blocks, self.length[at])


class Encoder:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        # every core has a task of its own; threads of a tokenizer beside it only take time from the others
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.pieces = Tokenizer(self.model.model)  # without normalisers and splitter
        added = (re.escape(t.content.encode()) for t in self.model.get_added_tokens_decoder().values())
        names = b"|".join(sorted(added))
        #: What the tokenizer looks for before all else, here in any case.
        self.added = re.compile(names, re.IGNORECASE) if names else None
        self.remembered = remembered
        # new words go to a small memory, which joins the large one now and then
        self.old, self.new = Memory(), Memory()

    def _forget(self) -> None:
        """Keep the words met again, if that leaves room for others, so that common words are not
        learned anew with every rare one."""
        again = self.old.joined(self.new).of_met()
        self.old, self.new = again if 4 * len(again.keys) <= 3 * self.remembered else Memory(), Memory()

    def _learn(self, words: Words, data: np.ndarray, which: np.ndarray) -> Memory:
        """The ids of some words, in the order of their hashes."""
        which = which[np.argsort(words.hash[which], kind="stable")]
        ids, size = self._encode_words(words, data, which)
        blocks = words.blocks[_spread(words.first_block[which], words.n_blocks[which])]
        return Memory(words.hash[which], ids, size, blocks, words.length[which])

    def _remember(self, made: Memory) -> None:
        self.new = self.new.joined(made)
        if 4 * len(self.new.keys) > len(self.old.keys):
            self.old, self.new = self.old.joined(self.new), Memory()

    def _known(self, words: Words, keys: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words have a hash that is remembered, and which of these are another word."""
        known = np.zeros(len(which), bool)
        alone = np.zeros(len(which), bool)
        for memory in (self.old, self.new):
            place = memory.find(keys)
            here = np.flatnonzero(place >= 0)
            known[here] = True
            memory.met[place[here]] = True
            alone[here] = ~same_blocks(
                words.blocks, words.first_block[which[here]], words.length[which[here]],
                memory.blocks, memory.first_block[place[here]], memory.length[place[here]],
            )
        return known, alone

    def _ids_of(self, words: Words, data: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words, no two of one hash, end to end, and how many each has."""
        keys = words.hash[which]
        known, alone = self._known(words, keys, which)
        if len(self.old.keys) + len(self.new.keys) + np.count_nonzero(~known) > self.remembered:
            self._forget()
            known, alone = self._known(words, keys, which)
        if not known.all():
            self._remember(self._learn(words, data, which[~known]))
        sources = [(m, np.where(alone, -1, m.find(keys))) for m in (self.old, self.new)]
        if alone.any():
            apart = self._learn(words, data, which[alone])
            sources.append((apart, np.where(alone, apart.find(keys), -1)))
        size = np.zeros(len(which), np.int64)
        for memory, place in sources:
            size[place >= 0] = memory.size[place[place >= 0]]
        start = np.cumsum(size) - size
        ids = np.zeros(int(size.sum()), np.uint32)
        for memory, place in sources:
            here = place >= 0
            ids[_spread(start[here], size[here])] = memory.ids[_spread(memory.at[place[here]], size[here])]
        return ids, size

    def _encode_words(self, words: Words, data: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words, end to end, and how many each has."""
        length = words.length[which]
        bounds = np.concatenate([[0], np.cumsum(length)])
        letters = data[_spread(words.start[which], length)]
        texts = pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(bounds), pa.py_buffer(letters))
        is_plain = pc.match_substring_regex(texts, _PLAIN)
        plain = is_plain.to_numpy(zero_copy_only=False)
        stems = pc.utf8_lower(texts.filter(is_plain)).to_numpy(zero_copy_only=False)
        whole = texts.filter(pc.invert(is_plain)).to_numpy(zero_copy_only=False).tolist()
        runs = (
            (plain, self.pieces, [t if t.isascii() else _by_bytes(t) for t in stems.tolist()]),
            (~plain, self.model, whole),
        )
        size = np.zeros(len(which), np.int64)
        made = []
        for own, model, strings in runs:
            ids, size[own] = _flat(model.encode_batch_fast(strings, add_special_tokens=False))
            made.append(ids)
        out = np.zeros(int(size.sum()), np.uint32)
        is_stem = np.repeat(plain, size)
        out[is_stem], out[~is_stem] = made
        return out, size

    def encode(self, column: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and where each text starts and ends. ``end`` is an id
        to put after each text."""
        data, words = units(*text_bytes(column), self.added)
        _, first, code = np.unique(words.hash, return_index=True, return_inverse=True)
        table, length = self._ids_of(words, data, first)
        unlike = np.flatnonzero(~words.same(np.arange(len(code)), first[code]))
        if len(unlike):  # another word of the same hash: a code of its own for each
            made, n = self._encode_words(words, data, unlike)
            code[unlike] = len(length) + np.arange(len(unlike))
            length = np.concatenate([length, n])
            table = np.concatenate([table, made])
        size = length[code]
        ids = table[_spread((np.cumsum(length) - length)[code], size)]
        extra = 0 if end is None else 1
        per_doc = np.bincount(words.doc, size, words.n_docs).astype(np.int64) + extra
        ends = np.cumsum(per_doc)
        if end is not None:
            out = np.full(int(ends[-1]) if len(ends) else 0, end, np.uint32)
            body = np.ones(len(out), bool)
            body[ends - 1] = False
            out[body] = ids
            ids = out
        return ids, np.concatenate([[0], ends])


def id_type(path: str) -> str:
    """The narrowest type of little-endian numbers that holds every id of a vocabulary."""
    return "<u2" if encoder(path).model.get_vocab_size() <= 1 << 16 else "<u4"


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One for each worker process, vocabulary and size of its memory."""
    key = (path, remembered)
    if key not in _loaded:
        _loaded[key] = Encoder(path, remembered)
    return _loaded[key]
