"""Pane semantics spelled out row by row, to compare the Spark forms against."""

from __future__ import annotations


def firings(ticks: dict[int, list[tuple[str, int, int]]], size: int, lateness: int, late_count: int = 1):
    """Panes of ``tick -> [(dim, time_ms, metric)]`` as a list of tuples."""
    state: dict[tuple[str, int], dict] = {}
    out = []
    watermark = None

    def fire(key, timing, values, last=False):
        s = state[key]
        early = timing == "EARLY"
        out.append(
            (
                key[0], key[1], timing, s["fired"], -1 if early else s["final"],
                s["fired"] == 0, last, len(values), sum(values),
                min(values, default=None), max(values, default=None),
                len(s["all"]), sum(s["all"]),
            )
        )
        s["fired"] += 1
        s["final"] += 0 if early else 1

    def advance():
        for key in sorted(state):
            s = state[key]
            if s["closed"] or watermark is None:
                continue
            if watermark >= key[1] + size and not s["passed"]:
                s["passed"] = True
                if s["all"]:
                    fire(key, "ON_TIME", [])
            if watermark >= key[1] + size + lateness:
                s["closed"] = True
                if s["wait"]:
                    fire(key, "LATE", s["wait"], last=True)

    for tick in sorted(ticks):
        rows = ticks[tick]
        new: dict[tuple[str, int], list[int]] = {}
        for dim, at, metric in rows:
            start = at // size * size
            if watermark is not None and watermark >= start + size + lateness:
                continue
            new.setdefault((dim, start), []).append(metric)
        for key, values in new.items():
            late = watermark is not None and watermark >= key[1] + size
            s = state.setdefault(
                key,
                {"all": [], "wait": [], "fired": 0, "final": 0, "passed": late, "closed": False},
            )
            s["all"] = s["all"] + values
            if not late:
                fire(key, "EARLY", values)
            else:
                s["wait"] = s["wait"] + values
                if len(s["wait"]) >= late_count:
                    fire(key, "LATE", s["wait"])
                    s["wait"] = []
        newest = max(at for _, at, _ in rows)
        watermark = newest if watermark is None else max(watermark, newest)
        advance()
    return out


def random_ticks(rng, size: int, count: int = 12) -> dict[int, list[tuple[str, int, int]]]:
    """Rows whose times jump about, so that some are late and some too late."""
    ticks = {}
    base = 1_704_067_200_000
    for tick in range(count):
        if tick and rng.random() < 0.15:
            continue
        rows = []
        for _ in range(rng.randint(1, 12)):
            back = rng.choice([0, 0, 0, size, 2 * size, 5 * size])
            at = base + tick * size // 2 + rng.randrange(size) - back
            rows.append((rng.choice(["a", "a", "a", "b"]), at, rng.randint(-5, 50)))
        ticks[tick] = rows
    return ticks
