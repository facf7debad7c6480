"""Burrows-Wheeler transforms of byte strings in shards, merged by refining their interleave.

Strings are read in letters of ``LETTER`` bytes: the suffix at byte x starts with the letter x..x+LETTER
and goes on with the suffix at x + LETTER, so a string is one sequence for each remainder. After the
last whole letter comes an end mark, each less than all letters and ordered by shard and place.

A shard's transform lists, for its suffixes in order, the letter before each. Merging needs only
these lists. An interleave says from which shard each place of the merged order comes. It starts as
one shard after the other; every round reads the letters through it and deals the places out by
letter, keeping their order, which sorts suffixes by one letter more. A place opens a block in the
first round that tells it from the place before it, so the rounds also give the common prefixes, in
letters; after ``n`` rounds a block holds the suffixes that agree in n letters.
"""

from __future__ import annotations

import numpy as np

LETTER = 25


def runs(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run, from the places where runs begin."""
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(new)))


def ordered(letter: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Suffixes of one shard in order.

    ``letter`` is 0 at end marks; ``after`` is the suffix one letter on, or any at an end mark.
    """
    ends = letter == 0
    marks = np.count_nonzero(ends)
    rank = letter.astype(np.int64) + marks
    rank[ends] = np.arange(marks)
    reach = after
    order = np.argsort(rank, kind="stable")
    new = np.ones(len(rank), bool)
    new[1:] = rank[order[1:]] != rank[order[:-1]]
    first, length = runs(new)
    rank[order] = np.repeat(first, length)
    tied = order[np.repeat(length > 1, length)]
    while len(tied):
        # Suffixes that share a rank differ by the rank of what follows the letters compared so far.
        key = rank[tied] * np.int64(len(rank)) + rank[reach[tied]]
        inner = np.argsort(key)
        tied, key = tied[inner], key[inner]
        base = rank[tied]
        new, group = np.ones(len(tied), bool), np.ones(len(tied), bool)
        new[1:], group[1:] = key[1:] != key[:-1], base[1:] != base[:-1]
        at = np.arange(len(tied))
        rank[tied] = base + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        length = runs(new)[1]
        tied = tied[np.repeat(length > 1, length)]
        reach = reach[reach]
    out = np.empty(len(rank), np.int64)
    out[rank] = np.arange(len(rank))
    return out


def merged(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' suffixes and the block of each place, after so many rounds."""
    sizes = [len(t) for t in transforms]
    total = sum(sizes)
    letters = np.concatenate(transforms).astype(np.int64)
    # As many end marks as beginnings, and in the order of the shards whatever precedes them.
    marks = np.repeat(np.arange(len(sizes), dtype=np.uint8), [np.count_nonzero(t == 0) for t in transforms])
    interleave = np.repeat(np.arange(len(sizes), dtype=np.uint8), sizes)
    block = np.zeros(total, np.int64)
    bits = np.int64(max(1, total.bit_length()))
    low = (np.int64(1) << bits) - 1
    for _ in range(rounds):
        read = np.empty(total, np.int64)
        read[np.argsort(interleave, kind="stable")] = letters
        dealt = np.sort((read << bits) | np.arange(total))[len(marks) :] & low
        new = np.ones(total, bool)
        new[len(marks) + 1 :] = (read[dealt[1:]] != read[dealt[:-1]]) | (block[dealt[1:]] != block[dealt[:-1]])
        interleave = np.concatenate([marks, interleave[dealt]])
        block = np.cumsum(new) - 1
    return interleave, block


def repeated(strings: list[bytes], shard: np.ndarray, length: int, letters_of) -> tuple[np.ndarray, np.ndarray]:
    """(string, byte) where a run of ``length`` bytes begins that also begins before.

    Before is in an earlier string, or earlier in the same one. ``letters_of(data, starts)`` gives
    hashes of LETTER bytes from each start; ``length`` is a multiple of LETTER.
    """
    sizes = np.array([len(s) for s in strings])
    data = np.frombuffer(b"".join(strings), np.uint8)
    string = np.repeat(np.arange(len(sizes)), sizes + 1)
    base = np.cumsum(sizes + 1) - sizes - 1
    place = np.arange(len(string)) - base[string]
    whole = place + LETTER <= sizes[string]
    letter = np.zeros(len(string), np.int64)
    begins = (np.arange(len(string)) - string)[whole]
    letter[whole] = np.unique(letters_of(data, begins), return_inverse=True)[1] + 1
    # A string shorter than a letter has fewer remainders than LETTER; all its suffixes are end marks.
    before = np.where(place >= LETTER, letter[np.maximum(np.arange(len(string)) - LETTER, 0)], 0)
    orders, transforms = [], []
    for s in np.unique(shard):
        own = np.flatnonzero(shard[string] == s)
        here = np.empty(len(string), np.int64)
        here[own] = np.arange(len(own))
        after = here[np.where(whole[own], own + LETTER, own)]
        order = own[ordered(letter[own], after)]
        orders.append(order)
        transforms.append(before[order])
    interleave, block = merged(transforms, length // LETTER)
    suffix = np.empty(len(string), np.int64)
    suffix[np.argsort(interleave, kind="stable")] = np.concatenate(orders)
    long_enough = place[suffix] + length <= sizes[string[suffix]]
    suffix, block = suffix[long_enough], block[long_enough]
    if not len(suffix):
        return suffix, suffix
    new = np.ones(len(block), bool)
    new[1:] = block[1:] != block[:-1]
    starts, lengths = runs(new)
    earliest = np.repeat(np.minimum.reduceat(suffix, starts), lengths)
    found = np.sort(suffix[suffix != earliest])
    return string[found], place[found]
