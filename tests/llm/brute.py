"""Plain forms of the operators, one text at a time."""

import re
from collections import Counter


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[j: j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_groups(docs, percent=85):
    sets = {i: shingles(t) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in docs}


def quality(text):
    t, w = text or "", words(text)
    counts = Counter(tuple(w[j: j + 8]) for j in range(len(w) - 7))
    covered = {k for j in range(len(w) - 7) if counts[tuple(w[j: j + 8])] > 1 for k in range(j, j + 8)}
    seen, repeated = set(), 0
    for line in t.split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), repeated, len(covered), failed


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text):
    t, out = text or "", []
    out += [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        out += [("card", m)] if 16 <= len(digits) <= 19 and luhn(digits) else []
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(kind, m.start(), m.end()) for kind, m in out]


def template_words(text, units):
    """(value, kind or None) of each word: outer punctuation gone, small letters, kinds number, unit and name."""
    out, opens, seen_end = [], True, 0
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text or ""):
        opens = opens or "\n" in text[seen_end: m.start()]
        seen_end = m.end()
        core = re.sub(r"^[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+|[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+$", "", m[0])
        if core:
            value = re.sub("[A-ZÀ-ÖØ-Þ]", lambda c: c[0].lower(), core)
            kind = None
            if "0" <= core[0] <= "9":
                kind = "number"
            elif out and out[-1][1] == "number" and value in units:
                kind = "unit"
            elif value[0] != core[0] and not opens and len(core) > 1 and value[1] == core[1]:
                kind = "name"
            out.append((value, kind))
        opens = m[0][-1] in ".!?"
    return out


def template_windows(words, size=8, plain=5):
    """(place, key, slots) of the windows with enough plain words."""
    for at in range(len(words) - size + 1):
        part = words[at: at + size]
        if sum(k is None for _, k in part) >= plain:
            yield at, tuple(k or (v,) for v, k in part), [v for v, k in part if k]


def template_leaks(docs, items, units):
    """(doc, item) -> (n_windows, n_found) of items with at least three windows, by the rules of the operator's docstring."""
    known, total = {}, {}
    for i, text in items.items():
        found = list(template_windows(template_words(text, units)))
        total[i] = len(found)
        for at, key, slots in found:
            known.setdefault(key, []).append((i, at, slots))
    out = {}
    for d, text in docs.items():
        seen = {}
        for place, key, slots in template_windows(template_words(text, units)):
            for i, at, own in known.get(key, []):
                half, shift = max(-(-total[i] // 2), 1), place - at
                for where in ((0, 0), (1, shift), (2, shift // (2 * half)), (3, (shift + half) // (2 * half))):
                    places, filled = seen.setdefault((i, where), (set(), {}))
                    places.add(at)
                    for x, y in zip(own, slots):
                        filled.setdefault(x, Counter())[y] += 1
        for (i, (way, _)), (places, filled) in seen.items():
            most = sum(max(c.values()) for c in filled.values())
            consistency = most / sum(sum(c.values()) for c in filled.values()) if filled else 1.0
            same = all(c.most_common(1)[0][0] == x for x, c in filled.items())
            whole = way == 0 or same or len(places) == total[i]
            if whole and len(places) >= min(3, total[i]) and consistency >= 0.8:
                out[d, i] = max(out.get((d, i), (0, 0)), (total[i], len(places)))
    return out
