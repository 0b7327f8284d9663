"""Burrows-Wheeler transforms of shards, and their merge by iterative interleave refinement.

A shard is some byte strings one after the other. Its letters are runs of
``letter`` bytes, so the string is read in ``letter`` phases and the letter
before place t starts at t - letter; each string is taken as a cycle, so every
place has a letter before it. ``transform`` sorts a shard's places by their
next ``depth`` letters (prefix doubling) and keeps the order and, for each
place in it, the letter before: the transform.

``merge`` finds the common order of all shards' places from the transforms
alone, without sorting suffixes again (Holt and McMillan): an *interleave*
says for each slot of the common order from which shard the next place comes.
At first the shards stand one after the other. In each round the letters
before are dealt to their buckets in the present order; the shard numbers
follow them and make the next interleave. After k rounds it is the order by
the first k letters, and the slots with equal first k letters are neighbours:
their borders are refined along with it, which gives the common prefixes as
far as they are asked for. After ``depth`` rounds each interval of two or more
slots is a string of ``depth`` letters that occurs more than once.

Places of one shard that share ``depth`` letters may stand in any order in it:
rounds up to ``depth`` never look behind them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

@dataclass
class Shard:
    """Places in sorted order and the code of the letter before each."""

    order: np.ndarray
    before: np.ndarray


def sort_pairs(a: np.ndarray | None, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank): the order by (a, b) or by b alone, ties by place, and each place's dense rank."""
    n = len(b)
    place_bits, b_bits = n.bit_length(), int(b.max()).bit_length()
    a_bits = 0 if a is None else int(a.max()).bit_length()
    rank = np.empty(n, np.int32)
    new = np.empty(n, np.int32)
    new[0] = 0
    if place_bits + b_bits + a_bits < 64:
        key = b.astype(np.int64) if a is None else a.astype(np.int64) << b_bits | b
        key <<= place_bits
        key |= np.arange(n)
        key.sort()
        order = key & ((1 << place_bits) - 1)
        key >>= place_bits
        np.cumsum(key[1:] != key[:-1], out=new[1:])
    else:
        order = np.argsort(b, kind="stable") if a is None else np.lexsort((b, a))
        differ = b[order[1:]] != b[order[:-1]]
        if a is not None:
            differ |= a[order[1:]] != a[order[:-1]]
        np.cumsum(differ, out=new[1:])
    rank[order] = new
    return order, rank


def transform(codes: np.ndarray, after: np.ndarray, before: np.ndarray, depth: int) -> Shard:
    """The transform of a shard: ``codes`` of the letters at its places, and the places one
    letter after and before each."""
    order, rank = (sort_pairs(None, codes)[0], codes) if depth == 1 else (None, codes)
    have, step, ahead = 1, 1, after  # ``ahead``: the place ``step`` letters after each
    while have < depth:
        more = min(have, depth - have)
        while step * 2 <= more:
            ahead, step = ahead[ahead], step * 2
        jump, done = (ahead, step) if step <= more else (after, 1)
        while done < more:
            jump, done = after[jump], done + 1
        order, rank = sort_pairs(rank, rank[jump])
        have += more
    return Shard(order, codes[before[order]])


def _own(interleave: np.ndarray, values: list[np.ndarray], kind) -> np.ndarray:
    """For each slot the next value of its shard."""
    out = np.empty(len(interleave), kind)
    if len(values) > 16:
        out[np.argsort(interleave, kind="stable")] = np.concatenate(values)
    else:
        for i, v in enumerate(values):
            out[interleave == i] = v
    return out


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(interleave, interval): the shard number and the interval number of each slot of the
    common order by the first ``depth`` letters."""
    sizes = [len(s.order) for s in shards]
    n = sum(sizes)
    kind = np.uint8 if len(shards) <= 256 else np.uint16 if len(shards) <= 65536 else np.int64
    interleave = np.repeat(np.arange(len(shards), dtype=kind), sizes)
    letters = [s.before for s in shards]
    interval = np.zeros(n, np.int32)
    low = n.bit_length()
    slot, mask = np.arange(n, dtype=np.int64), (1 << low) - 1
    for _ in range(depth):
        # each slot's letter: a shard's letters in the order of its slots
        key = _own(interleave, letters, np.int64)
        key <<= low
        key |= slot
        key.sort()  # to the letters' buckets, the present order kept in each
        order = key & mask
        key >>= low
        interleave, was = interleave[order], interval[order]
        new = key[1:] != key[:-1]
        new |= was[1:] != was[:-1]
        np.cumsum(new, out=interval[1:])
    return interleave, interval


@dataclass
class Repeats:
    """Places of the strings in the common order, and the interval each is in."""

    place: np.ndarray
    interval: np.ndarray


def letter_codes(strings: np.ndarray, letter: int) -> np.ndarray:
    """The rank of the ``letter`` bytes from each place on (zeros after the end)."""
    n, have, codes = len(strings), 0, None
    wide = np.concatenate([strings, np.zeros(letter, np.uint8)]).astype(np.int64)
    while have < letter:  # five bytes at a time
        more = min(5, letter - have)
        value = np.zeros(n, np.int64)
        for i in range(have, have + more):
            value <<= 8
            value |= wide[i : i + n]
        codes = sort_pairs(codes, value if codes is None else sort_pairs(None, value)[1])[1]
        have += more
    return codes


def repeats(strings: np.ndarray, ends: np.ndarray, window: int, letter: int, shard_bytes: int) -> Repeats:
    """The common order, by their next ``window`` bytes, of all places of the strings
    ``strings[ends[i - 1] : ends[i]]``, whose lengths are multiples of ``letter``; near a
    string's end a place reads on at its beginning."""
    depth, n = window // letter, len(strings)
    codes = letter_codes(strings, letter)
    starts = np.concatenate([[0], ends[:-1]])
    edge = np.arange(letter)
    after = np.arange(letter, n + letter, dtype=np.int32)
    before = np.arange(-letter, n - letter, dtype=np.int32)
    after[((ends - letter)[:, None] + edge).ravel()] = (starts[:, None] + edge).ravel()
    before[(starts[:, None] + edge).ravel()] = ((ends - letter)[:, None] + edge).ravel()
    shards, at, bounds = [], 0, []
    while at < n:
        last = max(int(np.searchsorted(ends, at + shard_bytes, side="right")) - 1, int(np.searchsorted(ends, at, side="right")))
        end = int(ends[last])
        shards.append(transform(codes[at:end], after[at:end] - at, before[at:end] - at, depth))
        bounds.append(at)
        at = end
    interleave, interval = merge(shards, depth)
    place = _own(interleave, [s.order + b for s, b in zip(shards, bounds)], np.int64)
    return Repeats(place, interval)
