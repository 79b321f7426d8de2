"""Plain models of operators: word by word and pair by pair, with nothing of theirs but fixed limits."""

import collections
import itertools
import math
import re

import zstandard

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def base_quality(text):
    """Words, their characters, symbols, repeated lines, words in repeated windows."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {g for g, n in collections.Counter(grams).items() if n > 1}
    hit = {i + k for i, g in enumerate(grams) if g in many for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def quality(text, bands, chunk_band, chunk_share, chunk=4096, level=3):
    """Reason (None: kept), ratio and share of chunks outside their band."""
    n, _, _, _, repeated = base_quality(text)
    raw = (text or "").encode()
    pack = lambda b: len(zstandard.ZstdCompressor(level=level).compress(b)) / len(b)
    ratio = pack(raw) if raw else None
    share = None
    if len(raw) > chunk:
        pieces = [raw[i : i + chunk] for i in range(0, len(raw) - chunk, chunk)] + [raw[-chunk:]]
        ratios = [pack(p) for p in pieces]
        share = len([r for r in ratios if r < chunk_band[0] or r > chunk_band[1]]) / len(ratios)
    if n < 50 or repeated * 100 > n * 50:
        return "base", ratio, share
    low, high = [(lo, hi) for least, lo, hi in bands if len(raw) >= least][-1]
    if ratio < low:
        return "repetitive", ratio, share
    if ratio > high:
        return "incompressible", ratio, share
    return ("chunks" if share is not None and share > chunk_share else None), ratio, share


def near_classes(rows, threshold=0.8, shingle=5):
    """Sorted (doc_id, class id), by the weighted Jaccard similarity of all pairs: shingles count as often as they stand there, times the mean of their words' log(1 + documents / documents with the word)."""
    words = [words_of(t) for _, t in rows]
    df = collections.Counter(w for ws in words for w in set(ws))
    idf = {w: math.log1p(len(rows) / n) for w, n in df.items()}
    vectors = []
    for ws in words:
        grams = [tuple(ws[i : i + shingle]) for i in range(len(ws) - shingle + 1)] if len(ws) >= shingle else [tuple(ws)] if ws else []
        vectors.append({g: n * sum(idf[w] for w in g) / len(g) for g, n in collections.Counter(grams).items()})
    totals = [sum(v.values()) for v in vectors]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for i, j in itertools.combinations(range(len(rows)), 2):
        if not vectors[i] or not vectors[j] or min(totals[i], totals[j]) < threshold * max(totals[i], totals[j]):
            continue
        common = sum(min(w, vectors[j][g]) for g, w in vectors[i].items() if g in vectors[j])
        if common >= threshold * (totals[i] + totals[j] - common):
            parent[find(j)] = find(i)
            links += 1
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, least[find(i)]) for i, (d, _) in enumerate(rows)), links


def chat_rendering(turns):
    """The cheapest legal sequence of a short conversation by trying every one, and its rendering. Turns are (role, text)."""
    order = ("system", "user", "assistant")
    follows = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    best = {None: (0, "")}
    for role, text in turns:
        after = {}
        for state, (cost, shown) in best.items():
            for new in order:
                change = 0 if new == role else 2 if role not in order and new != "system" else 4
                options = []
                if new in follows[state]:
                    options.append((change, f"<|{new}|>\n{text or ''}\n"))
                if new == state:
                    options.append((change + 1, f"{text or ''}\n"))
                for empty in follows[state]:
                    if new in follows[empty]:
                        options.append((change + 3, f"<|{empty}|>\n\n<|{new}|>\n{text or ''}\n"))
                for more, piece in options:
                    if new not in after or cost + more < after[new][0]:
                        after[new] = (cost + more, shown + piece)
        best = after
    return best
