"""Places in the stream of the seeded generator, reached without drawing what lies before.

The generator's words obey a linear recurrence over GF(2). With ``x**n`` reduced modulo its
characteristic polynomial, a state ``n`` words ahead is a sum of words near the start, so a task
can begin at any place of the stream by some forty squarings.
"""

from __future__ import annotations

import random
import sys
from functools import lru_cache

import numpy as np
from pyspark import cloudpickle

# Fixed values of the generator: words of its state, the degree of its polynomial.
WORDS = 624
DEGREE = 19937
_WORDS_PER_DRAW = 2
_ROWS = 1 << 10


def seeded(seed: int) -> np.random.RandomState:
    """NumPy generator that continues the stream of ``random.Random(seed)``."""
    state = random.Random(seed).getstate()[1]
    return _generator(np.array(state[:-1], dtype=np.uint32), state[-1])


def at_draw(seed: int, position: int, polynomial: int) -> np.random.RandomState:
    """Generator of ``seed`` whose next draw is that of ``position``, from 0.

    ``polynomial`` is that of :func:`characteristic`. The cost grows with the digits of the position.
    """
    if position == 0:
        return seeded(seed)
    power = _power_of_x(position * _WORDS_PER_DRAW, polynomial)
    bits = np.unpackbits(
        np.frombuffer(power.to_bytes(DEGREE // 8 + 1, "little"), np.uint8), bitorder="little")
    summands = np.flatnonzero(bits)
    stretches = np.lib.stride_tricks.sliding_window_view(_words(seed, DEGREE + WORDS), WORDS)
    state = np.zeros(WORDS, np.uint32)
    for begin in range(0, len(summands), _ROWS):
        state ^= np.bitwise_xor.reduce(stretches[summands[begin : begin + _ROWS]], axis=0)
    return _generator(state, WORDS)


@lru_cache(maxsize=1)
def characteristic() -> int:
    """Characteristic polynomial, bit ``i`` for ``x**i``: the shortest recurrence (Berlekamp and Massey)
    of the top bits of any stream, since the polynomial is irreducible."""
    connection, earlier, gap, length, recent = 1, 1, 1, 0, 0
    held = (1 << (DEGREE + 1)) - 1
    for at, bit in enumerate((_words(0, 2 * DEGREE) >> 31).tolist()):
        recent = ((recent << 1) | bit) & held
        if not (connection & recent).bit_count() & 1:
            gap += 1
        elif 2 * length <= at:
            connection, earlier = connection ^ (earlier << gap), connection
            length, gap = at + 1 - length, 1
        else:
            connection ^= earlier << gap
            gap += 1
    return int(format(connection, f"0{DEGREE + 1}b")[::-1], 2)


def _generator(words: np.ndarray, used: int) -> np.random.RandomState:
    twister = np.random.RandomState()
    twister.set_state(("MT19937", words, used))
    return twister


@lru_cache(maxsize=4)
def _words(seed: int, count: int) -> np.ndarray:
    """The first words of a stream before tempering, those of the seeded state included."""
    twister = seeded(seed)
    blocks = [twister.get_state()[1]]
    for _ in range(-(-count // WORDS)):
        twister.random_sample(WORDS // _WORDS_PER_DRAW)
        blocks.append(twister.get_state()[1])
    return np.concatenate(blocks)[: count + 1]


def _power_of_x(exponent: int, polynomial: int) -> int:
    """``x**exponent`` modulo the polynomial."""
    lower = [i for i in range(DEGREE) if polynomial >> i & 1]
    below = (1 << DEGREE) - 1
    power = 1
    for digit in format(exponent, "b"):
        power = _squared(power) << int(digit)
        while power >> DEGREE:
            excess, power = power >> DEGREE, power & below
            for i in lower:
                power ^= excess << i
    return power


def _squared(value: int) -> int:
    """Square over GF(2): a zero after every bit."""
    held = np.frombuffer(value.to_bytes(-(-value.bit_length() // 8) or 1, "little"), np.uint8)
    spaced = np.zeros((len(held) * 8, 2), np.uint8)
    spaced[:, 0] = np.unpackbits(held, bitorder="little")
    return int.from_bytes(np.packbits(spaced.ravel(), bitorder="little").tobytes(), "little")


# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
