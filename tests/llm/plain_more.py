"""Plain models of exact copies, conversation repair and spelling variants."""

import collections
import hashlib
import re
import zlib


def exact_copies(rows):
    """Of (doc_id, text), sorted: doc_id, keep_id, group size, kept, digest."""
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda d: (d is None, d))
        out += [(d, ids[0], len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()) for k, d in enumerate(ids)]
    return sorted(out, key=repr)


def repaired(rows, damage=True):
    """Of (conv_id, turn, role, text): by conversation, gaps, blank, duplicate, truncated, illegal, cost, audit, digest."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        here = convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        here += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {conv: _cheapest(turns) for conv, turns in convs.items()}


def _cheapest(turns):
    turns = sorted(turns, key=lambda a: (a[0] is not None, a[0] or 0, a[1].encode(), hashlib.sha256(a[2].encode()).digest()))
    numbers = [t for t, _, _ in turns if t is not None]
    seen, faults = set(), []
    for _, role, text in turns:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    names = {"u": "user", "a": "assistant"}
    # from the end: the least (cost, letters) after each last initial, and the turns that they give
    best = {"": (0, "", ()), "a": (0, "", ())}

    def with_insertions(best):
        for _ in range(4):
            for before, z in follows:
                if z in names and z in best:
                    cost, letters, out = best[z]
                    best[before] = min(best.get(before, (1 << 60, "", ())), (cost + 3, "I" + letters, (names[z] + ":", *out)), key=lambda x: x[:2])

    with_insertions(best)
    for (_, role, text), fault in zip(reversed(turns), reversed(faults)):
        now = {}
        for last in ("", "s", "u", "a"):
            options = []
            if last in best:
                cost, letters, out = best[last]
                options.append((cost + 4, "D" + letters, out))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                if (last, role[:1]) in follows and role[:1] in best:
                    cost, letters, out = best[role[:1]]
                    options.append((cost + more, "K" + letters, (f"{role}:{text}", *out)))
                for z, name in names.items():
                    if (last, z) in follows and z in best:
                        cost, letters, out = best[z]
                        options.append((cost + 3 + more, "R" + letters, (f"{name}:{text}", *out)))
            if options:
                now[last] = min(options, key=lambda x: x[:2])
        best = now
        with_insertions(best)
    cost, letters, out = best[""]
    initials = [r[:1] for _, r, _ in turns]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, letters, hashlib.sha256("\n".join(out).encode()).hexdigest()


def spelling(rows):
    """Of (doc_id, text): by word, form, root, n, near words, the form's n."""
    n = collections.Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: set() for w in n}
    holes = collections.defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            if (short := w[:i] + w[i + 1 :]) in n:
                near[w].add(short)
                near[short].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {w: min(near[w], key=lambda o: (-n[o], o), default=None) for w in n}
    form = {w: f if f is not None and n[f] >= 2 * n[w] else None for w, f in form.items()}
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out
