"""The reports over lists of tuples, one row at a time, to compare small results with."""

import re
from collections import Counter, defaultdict

TIME = re.compile(r"[ \t]*([0-9]+):[ \t]*([0-9]+):[ \t]*([0-9]+)")


def seconds(text):
    found = TIME.match(text)
    if not found:
        return None
    h, m, s = map(int, found.groups())
    return h * 3600 + m * 60 + s


def top_models(flights, aircrafts, manufacturer, n):
    counts = Counter()
    for flight in flights:
        for tail, made_by, model in aircrafts:
            if tail == flight[2] and made_by == manufacturer:
                counts["Cessna " + re.sub("[^0-9]+", " ", model).strip(" ")[:3]] += 1
    return sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:n]


def departure_delay(flights, aircrafts, airlines, year, country, minutes, once):
    delays = defaultdict(list)
    for carrier, date, tail, scheduled, actual in flights:
        if date[:4] != year or seconds(scheduled) is None or seconds(actual) is None:
            continue
        if not seconds(scheduled) < seconds(actual):
            continue
        delay = (seconds(actual) - seconds(scheduled)) // 60
        delay = delay % 60 if minutes == "of_hour" else delay
        listings = sum(a[0] == tail for a in aircrafts)
        for code, name, where in airlines:
            if code == carrier and country in where and delay > 0:
                delays[name] += [delay] * (min(listings, 1) if once else listings)
    return sorted((name, len(d), sum(d) // len(d), min(d), max(d)) for name, d in delays.items() if d)


def popular_types(flights, aircrafts, airlines, country, n, measure):
    used = defaultdict(list)
    for carrier, _, tail, _, _ in flights:
        for code, name, where in airlines:
            for listed, made_by, model in aircrafts:
                if code == carrier and listed == tail and (country is None or country in where):
                    used[name, f"{made_by} {model}"].append(tail)
    per_airline = defaultdict(list)
    for (name, kind), tails in used.items():
        per_airline[name].append((-(len(tails) if measure == "flights" else len(set(tails))), kind))
    return sorted((name, "[" + ", ".join(t for _, t in sorted(types)[:n]) + "]") for name, types in per_airline.items())
