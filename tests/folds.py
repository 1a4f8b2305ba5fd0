"""Plain sequential statements of the ordered rules, for comparing with the Spark versions.

Written from the rules' meaning, one row after the other, with no regard for speed.
"""

from __future__ import annotations

from math import dist


def centre(b):
    return b[0] + b[2] / 2, b[1] + b[3] / 2


def feet(b):
    return b[0] + b[2] / 2, b[1] + b[3]


def overlap(a, b):
    w = max(0, min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]))
    h = max(0, min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1]))
    return w * h / (a[2] * a[3] + b[2] * b[3] - w * h + 1e-9)


def within(p, b):
    return b[0] <= p[0] <= b[0] + b[2] and b[1] <= p[1] <= b[1] + b[3]


def head_fits(h, p):
    x, y = centre(h)
    return p[0] <= x <= p[0] + p[2] and p[1] <= y <= p[1] + p[3] * 0.5


class Tracks:
    def __init__(self, reach, ttl):
        self.reach, self.ttl, self.count, self.live = reach, ttl, 1, {}

    def see(self, points, now):
        """Track numbers for the points of one frame."""
        self.live = {k: v for k, v in self.live.items() if now - v[1] <= self.ttl}
        numbers = []
        for p in points:
            free = [(dist(p, at), k) for k, (at, _) in self.live.items() if k not in numbers]
            near = min(free, default=(float("inf"), None))
            number = near[1]
            if near[0] > self.reach:
                number = self.count
                self.count += 1
            self.live[number] = (p, now)
            numbers.append(number)
        return numbers


class Seen:
    def __init__(self, seconds=3.0, reach=50.0):
        self.seconds, self.reach, self.kept = seconds, reach, []

    def again(self, track, p, now):
        return any(now - t < self.seconds and (k == track or dist(p, q) < self.reach) for t, k, q in self.kept)

    def keep(self, track, p, now):
        self.kept.append((now, track, p))


def cooldown(times, seconds):
    kept = []
    for t in times:
        if not kept or t - kept[-1] >= seconds:
            kept.append(t)
    return kept


def side(p, line):
    x1, y1, x2, y2 = line[:4]
    cross = (x2 - x1) * (p[1] - y1) - (y2 - y1) * (p[0] - x1)
    return 0 if abs(cross) < 1e-6 else (1 if cross > 0 else -1)


def gap(p, line):
    x1, y1, x2, y2 = line[:4]
    size = (x2 - x1) ** 2 + (y2 - y1) ** 2
    t = 0 if size == 0 else max(0, min(1, ((p[0] - x1) * (x2 - x1) + (p[1] - y1) * (y2 - y1)) / size))
    return dist(p, (x1 + t * (x2 - x1), y1 + t * (y2 - y1)))


class Lanes:
    """Sides per track; one report per sighting; tracks missing from a frame are forgotten."""

    def __init__(self, lines, limit):
        self.lines, self.limit, self.sides = lines, limit, {}

    def frame(self, sightings):
        out = []
        for track, p in sightings:
            if track not in self.sides:
                self.sides[track] = [side(p, ln) for ln in self.lines]
                continue
            mine = self.sides[track]
            for i, ln in enumerate(self.lines):
                if ln[4] != "solid":
                    continue
                now, before = side(p, ln), mine[i]
                if now:
                    mine[i] = now
                if now and before and now != before and gap(p, ln) < 2 * self.limit:
                    out.append((track, i, before, now))
                    break
        for track in set(self.sides) - {t for t, _ in sightings}:
            del self.sides[track]
        return out


def heads_of(heads, persons):
    """First free person per head."""
    used, out = set(), []
    for h in heads:
        pick = next((p for p in persons if p[0] not in used and head_fits(h[1], p[1])), None)
        if pick:
            used.add(pick[0])
        out.append((h, pick))
    return out


def riders_of(persons, vehicles):
    used, out = set(), []
    for v in vehicles:
        near = []
        for p in persons:
            inside, share = within(feet(p[1]), v[1]), overlap(p[1], v[1])
            if p[0] not in used and (inside or share >= 0.15):
                near.append((p, share + (0.1 if inside else 0.0)))
        near.sort(key=lambda n: -n[1])
        for p, _ in near[:3]:
            used.add(p[0])
            out.append((p, v))
    return out


def strongest(boxes, limit=0.4):
    kept = []
    for b in sorted(boxes, key=lambda b: -b[2]):
        if all(overlap(b[1], k[1]) <= limit for k in kept):
            kept.append(b)
    return kept


def helmet_frame(groups, tracks, seen, now):
    """Violations of one frame: (track, box, confidence, method)."""
    persons, vehicles, helmets, heads = (groups[k] for k in ("persons", "vehicles", "helmets", "heads"))

    def mix(p, v, f):
        return min(0.99, max(0.1, 0.25 * p + 0.25 * v + 0.5 * f))

    out, done = [], set()
    for head, person in heads_of(heads, persons):
        if person:
            done.add(person[0])
        box, trust = (person[1], person[2]) if person else (head[1], 0.6)
        ride = next((v for v in vehicles if overlap(box, v[1]) >= 0.15 or within(feet(box), v[1])), None)
        confidence = mix(trust, ride[2] if ride else 0.3, head[2])
        if ride:
            confidence = min(0.99, confidence + 0.1)
        if not seen.again(tracks.count, centre(head[1]), now):
            seen.keep(tracks.count, centre(head[1]), now)
            out.append((tracks.count, box, confidence, "direct_no_helmet" if ride else "head_only_detection"))
            tracks.count += 1
    for person, vehicle in riders_of(persons, vehicles):
        twin = next(p for p in persons if p[1] == person[1])
        if twin[0] in done:
            continue
        top = (person[1][0], person[1][1], person[1][2], max(1, int(person[1][3] * 0.4)))
        safe = any(overlap(h[1], top) >= 0.15 for h in helmets)
        track = tracks.see([centre(person[1])], now)[0]
        if safe:
            done.add(twin[0])
        elif not seen.again(track, centre(person[1]), now):
            seen.keep(track, centre(person[1]), now)
            ride = next(v for v in vehicles if v[1] == vehicle[1])
            out.append((track, person[1], mix(twin[2], ride[2], 0.6), "fallback_no_helmet"))
            done.add(twin[0])
    return out
