"""The packet rules taken one packet at a time, as plain Python: the brute-force check.

Written from the blueprint's rules: the place of a sample by its index formula, a loss
from the places of two triggers in the scan cycle, frames of fifteen rows.
"""

from packetloom.operators.packets import CYCLE, LOST_VALUE, ROW_WIDTH, TRIGGER_ORDER

PLACE = {trig: place for place, trig in enumerate(TRIGGER_ORDER)}
FRAME_ROWS = 15


def lost_between(prev, trig, mode):
    """Packets missing between two triggers; negative when the scan went back or stood."""
    if mode == "off":
        return 0
    came_from, now = PLACE[prev], PLACE[trig]
    if mode == "modular":
        return (now - came_from - 1) % CYCLE if now != came_from else 0
    in_turn = came_from < CYCLE and now == (came_from + 1) % CYCLE
    return 0 if in_turn else abs(now - came_from) - 1


def columns(samples):
    """Sample i of column c stands at c * 24 + (i mod 6) * 4 + i div 6."""
    return [
        [samples[c * ROW_WIDTH + i % 6 * 4 + i // 6] for i in range(ROW_WIDTH)]
        for c in range(len(samples) // ROW_WIDTH)
    ]


class Assembler:
    """One session: packets go in, ``frames`` and what each packet showed come out."""

    def __init__(self, mode="reference"):
        self.mode, self.last, self.total = mode, None, 0
        self.rows, self.frames, self.seen = [], [], []

    def _put(self, row):
        self.rows.append(row)

    def _cut(self):
        # a frame is let go when a row beyond it has come
        if len(self.rows) > FRAME_ROWS:
            self.frames.append(self.rows[:FRAME_ROWS])
            del self.rows[:FRAME_ROWS]

    def feed(self, seq, trig, samples):
        known = trig in PLACE or self.mode == "off"
        opened = self.last is not None or trig == 0
        if not (known and opened):
            return
        lost = 0 if self.last is None else lost_between(self.last, trig, self.mode)
        self.last = trig
        self.total += lost
        for _ in range(4 * lost):
            self._put([LOST_VALUE] * ROW_WIDTH)
            self._cut()
        for row in columns(samples):
            self._put(row)
        self._cut()
        self.seen.append((seq, lost, self.total, self.frames[-1] if self.frames else []))
