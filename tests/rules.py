"""The sequential rules in plain Python, written from their definitions."""

from fractions import Fraction

OPEN_END = 1.7976931348623157e308


def turns_of(segments):
    """``[(speaker, start, end)]`` from ``[(start, end, label)]``."""
    turns = []
    for position, (start, _, label) in enumerate(segments):
        if position == 0 or label != segments[position - 1][2]:
            if turns:
                turns[-1][2] = start
            turns.append([label, start, None])
    if turns:
        turns[-1][2] = segments[-1][1]
    return [tuple(t) for t in turns]


def align(turn_ends, chunk_ends):
    """``[(chunk, turn)]`` of the chunks that are taken."""
    ends = [OPEN_END if e is None else e for e in chunk_ends]
    taken, first = [], 0
    for turn, end in enumerate(turn_ends):
        left = range(first, len(ends))
        if not left:
            break
        cut = min(left, key=lambda i: (abs(Fraction(ends[i]) - Fraction(end)), i))
        taken += [(i, turn) for i in range(first, cut + 1)]
        first = cut + 1
    return taken
