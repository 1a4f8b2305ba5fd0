"""The ordered rules themselves: small per-row state machines shared by batch and streaming runs."""

from __future__ import annotations

import math

from kerbwatch.operators.fold import Rule

# Track matching distance and lifetime, and the two repeat limits.
VEHICLE_DISTANCE, VEHICLE_TTL = 100.0, 2.0
RIDER_DISTANCE, RIDER_TTL = 80.0, 1.0
COOLDOWN = 3.0
REPEAT_SECONDS, REPEAT_DISTANCE = 3.0, 50.0

_X, _Y, _T, _ID, _NOTE = range(5)


class Tracker(Rule):
    """Nearest-centroid tracking: each box takes the closest live track not yet taken in its frame."""

    inputs = ("cx", "cy")
    outputs = "track_id bigint, is_new boolean"
    new_id = "track_id"

    def __init__(self, max_distance: float = VEHICLE_DISTANCE, ttl: float = VEHICLE_TTL):
        super().__init__()
        self.max_distance, self.memory = max_distance, ttl
        self.live: list[list] = []
        self.taken: set[int] = set()

    def load(self, slots):
        self.live = [[*content[:3], ident, content[3]] for content, ident in slots]
        self.taken = set()

    def slots(self, now):
        return [([s[_X], s[_Y], s[_T], s[_NOTE]], s[_T], s[_ID]) for s in self.live if now - s[_T] <= self.memory]

    def begin_frame(self, now):
        self.live = [s for s in self.live if now - s[_T] <= self.memory]
        self.taken = set()

    def place(self, now: float, cx: float, cy: float, note=None) -> tuple[list, bool]:
        best, best_distance, limit, taken = None, math.inf, self.max_distance, self.taken
        for slot in self.live:
            # no point is nearer than along x alone
            dx = cx - slot[_X]
            if dx > limit or -dx > limit or slot[_ID] in taken:
                continue
            distance = math.sqrt(dx ** 2 + (cy - slot[_Y]) ** 2)
            if distance < best_distance:
                best, best_distance = slot, distance
        fresh = best is None or best_distance > self.max_distance
        if fresh:
            best = [cx, cy, now, self.next_id, note]
            self.next_id += 1
            self.live.append(best)
        else:
            best[_X], best[_Y], best[_T] = cx, cy, now
        self.taken.add(best[_ID])
        return best, fresh

    def row(self, now, cx, cy):
        if cx is None:
            return None
        slot, fresh = self.place(now, cx, cy)
        return slot[_ID], fresh

    # a plain track has no note; the rules that add one keep their own state

    state = "x double, y double, t double, id bigint"

    def to_state(self, now):
        return [(s[_X], s[_Y], s[_T], s[_ID]) for s in self.live if now - s[_T] <= self.memory]

    def from_state(self, rows):
        self.live = [[x, y, t, ident, None] for x, y, t, ident in rows]
        self.taken = set()


class LaneWatch(Tracker):
    """Tracking, solid-line crossing and per-track cooldown in one pass.

    ``sides`` has one letter per lane line: L or R for the side, small letters when the line is out of
    reach, 0 on the line, - for lines that may be crossed. A row without a box only marks a frame.
    A track's note is [remembered sides, time of its last report, frame it was last seen in].
    """

    inputs = ("cx", "cy", "sides", "vehicle_type")
    outputs = "track_id bigint, first_type string, line_id int, from_side string, to_side string"

    def __init__(self, max_distance: float = VEHICLE_DISTANCE, ttl: float = VEHICLE_TTL, cooldown: float = COOLDOWN):
        super().__init__(max_distance, ttl)
        self.cooldown = cooldown

    def begin_frame(self, now):
        # a track that the previous frame did not show forgets its sides
        for slot in self.live:
            if slot[_ID] not in self.taken:
                slot[_NOTE][0] = None
        super().begin_frame(now)

    def slots(self, now):
        kept = super().slots(now)
        return [([x, y, t, [*note[:3], ident in self.taken]], t, ident) for (x, y, t, note), _, ident in kept]

    def load(self, slots):
        super().load(slots)
        self.taken = {s[_ID] for s in self.live if s[_NOTE][3]}
        for slot in self.live:
            slot[_NOTE] = slot[_NOTE][:3]

    def row(self, now, cx, cy, sides, vehicle_type):
        if cx is None:
            return None
        slot, _ = self.place(now, cx, cy, [None, None, vehicle_type])
        note = slot[_NOTE]
        note[0], crossed = cross(note[0], sides)
        if crossed is None or (note[1] is not None and now - note[1] < self.cooldown):
            return None
        note[1] = now
        line, before, after = crossed
        return slot[_ID], note[2], line, before, after


_NAMES = {"L": "left", "R": "right"}


def cross(remembered: str | None, sides: str) -> tuple[str, tuple[int, str, str] | None]:
    """Remembered sides after this sighting, and the first solid line crossed, if any.

    Lines behind the crossed one keep their old side until the next sighting.
    """
    if remembered is None:
        return sides.upper(), None
    kept = list(remembered)
    for i, letter in enumerate(sides):
        if letter in "-0":
            continue
        side, before = letter.upper(), kept[i]
        kept[i] = side
        if before in _NAMES and before != side and letter == side:
            return "".join(kept), (i, _NAMES[before], _NAMES[side])
    return "".join(kept), None


class RedLightWatch(Tracker):
    """Tracking and red-light crossing in one pass; a track is reported once.

    With ``require_transition`` a vehicle already past the line when it is first seen there under another
    light is not reported.
    """

    inputs = ("cx", "cy", "past_line", "is_red", "vehicle_type")
    outputs = "track_id bigint, first_type string"

    def __init__(self, max_distance: float = VEHICLE_DISTANCE, ttl: float = VEHICLE_TTL,
                 require_transition: bool = False):
        super().__init__(max_distance, ttl)
        self.require_transition = require_transition

    def row(self, now, cx, cy, past_line, is_red, vehicle_type):
        if cx is None:
            return None
        slot, _ = self.place(now, cx, cy, [False, vehicle_type])
        note = slot[_NOTE]
        if not past_line or note[0]:
            return None
        if is_red or self.require_transition:
            note[0] = True
        return (slot[_ID], note[1]) if is_red else None


class Cooldown(Rule):
    """At most one report per key within the cooldown, counted from the last report."""

    inputs = ()
    outputs = "kept boolean"

    def __init__(self, seconds: float = COOLDOWN):
        super().__init__()
        self.memory = seconds
        self.last: float | None = None

    def load(self, slots):
        self.last = slots[0][0][0] if slots else None

    def slots(self, now):
        return [] if self.last is None or now - self.last >= self.memory else [([self.last], self.last, 0)]

    def row(self, now):
        keep = self.last is None or now - self.last >= self.memory
        if keep:
            self.last = now
        return (True,) if keep else None


class Repeats(Rule):
    """Drops a report close in time to a kept one of the same track or nearly the same place."""

    inputs = ("track_id", "cx", "cy")
    outputs = "kept boolean"

    def __init__(self, seconds: float = REPEAT_SECONDS, distance: float = REPEAT_DISTANCE):
        super().__init__()
        self.memory, self.distance = seconds, distance
        self.recent: list[list] = []

    def load(self, slots):
        self.recent = [list(content) for content, _ in slots]

    def slots(self, now):
        self.recent = [r for r in self.recent if now - r[0] < self.memory]
        return [(r, r[0], 0) for r in self.recent]

    state = "t double, track_id bigint, x double, y double"

    def to_state(self, now):
        return [tuple(r) for r in self.recent if now - r[0] < self.memory]

    def from_state(self, rows):
        self.recent = [list(r) for r in rows]

    def seen(self, now: float, track: int, cx: float, cy: float) -> bool:
        limit, memory = self.distance, self.memory
        self.recent = [r for r in self.recent if now - r[0] < memory]
        for _, other, x, y in self.recent:
            if other == track:
                return True
            # no point is nearer than along x alone
            dx = cx - x
            if dx >= limit or -dx >= limit:
                continue
            if math.sqrt(dx ** 2 + (cy - y) ** 2) < limit:
                return True
        return False

    def row(self, now, track_id, cx, cy):
        if self.seen(now, track_id, cx, cy):
            return None
        self.recent.append([now, track_id, cx, cy])
        return (True,)


class HelmetWatch(Rule):
    """Numbering, rider tracking and repeat suppression of missing-helmet candidates.

    Candidates come in the order of the two strategies. Direct ones take the next free number and
    are checked by place only; fallback riders are tracked one at a time and may share a track.
    """

    inputs = ("direct", "cx", "cy", "has_helmet", "person")
    outputs = "track_id bigint, violation boolean"
    new_id = "track_id"

    def __init__(self, max_distance: float = RIDER_DISTANCE, ttl: float = RIDER_TTL):
        super().__init__()
        self.ttl = ttl
        self.tracker = Tracker(max_distance, ttl)
        self.repeats = Repeats()
        self.done: set[int] = set()
        self.memory = max(ttl, self.repeats.memory)

    @property
    def next_id(self):
        return self.tracker.next_id

    @next_id.setter
    def next_id(self, value):
        if "tracker" in self.__dict__:
            self.tracker.next_id = value

    def load(self, slots):
        tracks = [(c, i) for c, i in slots if c[0] == "track"]
        self.tracker.load([(c[1], i) for c, i in tracks])
        # a report names its track by label; reports of gone tracks only count by place
        ident = {c[2]: i for c, i in tracks}
        self.repeats.load([([c[1], ident.get(c[2]), c[3], c[4]], i) for c, i in slots if c[0] == "report"])

    def slots(self, now):
        tracks = self.tracker.slots(now)
        label = {ident: n for n, (_, _, ident) in enumerate(tracks)}
        reports = self.repeats.slots(now)
        return ([(["track", c, n], t, i) for n, (c, t, i) in enumerate(tracks)]
                + [(["report", r[0], label.get(r[1]), r[2], r[3]], t, 0) for r, t, _ in reports])

    state = "kind string, x double, y double, t double, id bigint"

    def to_state(self, now):
        return ([("track", *s) for s in self.tracker.to_state(now)] + [("report", x, y, t, k) for t, k, x, y in self.repeats.to_state(now)])

    def from_state(self, rows):
        self.tracker.from_state([r[1:] for r in rows if r[0] == "track"])
        self.repeats.from_state([(t, k, x, y) for kind, x, y, t, k in rows if kind == "report"])

    def begin_frame(self, now):
        self.done = set()

    def row(self, now, direct, cx, cy, has_helmet, person):
        if direct:
            track = self.tracker.next_id
            if self.repeats.seen(now, track, cx, cy):
                return None
            self.tracker.next_id += 1
            self.repeats.recent.append([now, track, cx, cy])
            return track, True
        if person in self.done:
            return None
        self.tracker.begin_frame(now)
        track = self.tracker.place(now, cx, cy)[0][_ID]
        if has_helmet:
            self.done.add(person)
            return track, False
        if self.repeats.seen(now, track, cx, cy):
            return None
        self.done.add(person)
        self.repeats.recent.append([now, track, cx, cy])
        return track, True
