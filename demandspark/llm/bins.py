"""Best fit of sizes into bins; travels with the tasks, see `packing`."""

from __future__ import annotations

import numpy as np


def best_fit(fills: np.ndarray, length: int) -> list[int]:
    """Of items ordered by falling size the bin each goes to: the open bin it leaves least room in, else a new one.

    Open bins are kept by their room; the rooms that occur are the bits of one integer, so the least room that is
    enough is its lowest bit from the item's size on.
    """
    by_room: dict[int, list[int]] = {}
    rooms, bins, target = 0, 0, []
    for size in fills.tolist():
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            stack = by_room[room]
            chosen = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room, chosen, bins = length, bins, bins + 1
        target.append(chosen)
        if left := room - size:
            by_room.setdefault(left, []).append(chosen)
            rooms |= 1 << left
    return target
