"""Personal data: weak supervision over candidate spans.

Candidates are the spans of four base kinds (email, ip, card, phone; always kept) and of the method's own kinds (secret,
iban, ssn, hidden_email, person, address). Labelers vote on each: a shape labeler (regular expressions, among them the
forms of keys that need no label before them), a check labeler (check digits, variety of characters), a cue labeler
(words of the kind before the span), a gazetteer labeler (given names, places and street words inside it), a context
labeler (what touches the span) and a labeler of placeholder values. Votes are 1, -1 or 0 (none). Expectation-maximisation over all candidates of
all documents estimates, for each kind, how common true spans are and how reliable each labeler is; its posteriors then
train the span classifier, a logistic model over votes, kind and length. Spans that it gives at least ``CUT`` are added.

Both fits need only how often each (kind, votes, features) pattern occurs, and the patterns are few by construction
(at most ``PATTERNS``), so all candidates count and nothing grows with the corpus on the driver.

Edge cases: a null or empty text has no spans. Spans are offsets in code points, end exclusive. Repeated rows are judged
one by one. Texts and spans are taken whole, however long, in time proportional to their length (an IBAN has 15 to 34
characters by its definition). Without any candidate nothing is fitted, and nothing is added. Of columns that share a
name with a computed one, the computed one stays.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import Slice, class_table, map_text, slices, unused

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "iban", "ssn", "hidden_email", "person", "address")
LABELERS = ("shape", "check", "cue", "context", "placeholder", "gazetteer")
#: How often each labeler is taken to be right before any data, and for how many spans that counts.
BELIEVED, BELIEVED_FOR = (0.75, 0.9, 0.75, 0.75, 0.98, 0.85), 10
PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 4
CUT = 0.5
EM_ROUNDS, FIT_ROUNDS, FIT_STEP, RIDGE = 50, 400, 0.5, 1e-3
CUE_CHARS = 40
FIELDS = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

# The base patterns. A look-behind only saves attempts that can't succeed.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_OWN = {
    "secret": re.compile(r"(?i)(?:(?<![A-Za-z])|(?<=(?-i:[a-z0-9]))(?=(?-i:[A-Z])))(?:password|passwd|pwd|token|secret|api[_-]?key)\s*+[=:]\s*+[\"']?([A-Za-z0-9_\-+/=.]{8,})"),
    "iban": re.compile(r"(?<![A-Za-z0-9])([A-Z]{2}[0-9]{2}(?:(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?|(?: ?[A-Z0-9]{4}){2} ?[A-Z0-9]{3}))(?![A-Za-z0-9])"),
    "ssn": re.compile(r"(?<![0-9-])([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"),
    "hidden_email": re.compile(r"(?i)(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?[(\[]dot[)\]] ?[A-Za-z0-9-]++)+)"),
    "person": re.compile(r"(?:\b(?i:name|contact|patient|customer|signed|author|attn) ?: ?|\bDear |\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señora?)\.? )([A-Z][a-zà-ÿ]++(?: [A-Z]\.)?(?:[ -][A-Z][a-zà-ÿ]++)*)"),
    "address": re.compile(r"(?<![A-Za-z0-9])([0-9]+[A-Za-z]?,? (?:[A-Z][A-Za-zà-ÿ]++\.? )+(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Square|Court|Place)(?![A-Za-z])|[A-ZÄÖÜ][a-zà-ÿ]+(?:straße|strasse|weg|platz|allee|gasse) [0-9]+[a-z]?(?![A-Za-z0-9]))"),
}
# How keys look that need no label, and what they begin with.
_KEYS = re.compile(
    r"(?<![A-Za-z0-9])(?:A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[A-Za-z0-9]{36,}+|github_pat_[A-Za-z0-9_]{22,}+|glpat-[A-Za-z0-9_-]{20,}+|xox[abeoprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])|[sr]k_live_[A-Za-z0-9]{16,}+|sk-[A-Za-z0-9_-]{20,}+|"
    r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+)|-----BEGIN [A-Z ]*?PRIVATE KEY-----(?:\s*[A-Za-z0-9-]++: [^\n]*+)*[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]*?PRIVATE KEY-----)?"
)
_STARTS = (*(x.encode() for x in ("Mr", "Ms", "Dr ", "Dr.", "Prof", "Herr", "Frau", "Monsieur ", "Madame ", "Señor", "Dear ")), b"AKIA", b"ASIA", b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_", b"github_pat_", b"glpat-", b"xox", b"AIza", b"k_live_", b"sk-", b"eyJ", b"-----BEGIN ")
# Given names and places.
GIVEN_NAMES = frozenset(
    "james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan joseph jessica thomas sarah charles karen daniel lisa matthew nancy anthony betty mark sandra paul ashley steven emily andrew donna kenneth michelle george carol joshua amanda kevin melissa brian deborah edward stephanie "
    "hans anna peter maria klaus ursula jürgen monika wolfgang petra stefan sabine jean marie pierre jeanne michel françoise luc claire antoine sophie juan carmen josé ana carlos laura miguel isabel luis marta giovanni giulia marco francesca wei li ahmed fatima mohamed aisha ivan olga".split()
)
PLACES = frozenset("london paris berlin madrid rome vienna lisbon dublin amsterdam brussels zurich geneva munich hamburg cologne lyon marseille barcelona sevilla milan york boston chicago houston dallas seattle denver toronto sydney melbourne tokyo".split())
#: Words that announce a kind.
CUES = {
    "email": ("mail", "contact", "write", "@"), "ip": ("ip", "host", "server", "address", "login"), "card": ("card", "visa", "pay", "credit"), "phone": ("phone", "call", "tel", "fax", "mobile"),
    "secret": ("password", "token", "secret", "key", "pwd", "login"), "iban": ("iban", "bank", "account", "konto"), "ssn": ("ssn", "social", "security"), "hidden_email": ("mail", "contact", "write"),
    "person": ("name", "contact", "dear", "patient", "customer", "signed", "author", "mr", "mrs"), "address": ("address", "lives", "live at", "ship", "office", "adresse", "visit"),
}
#: Values that stand for none.
PLACEHOLDERS = re.compile(r"(?i)\A0+(?:[. -]0+)*[. -]?\Z|127\.0\.0\.1|x{4,}|changeme|your[_-]|placeholder|000-00-0000|123-45-6789")
_WORTH = class_table(lambda b: chr(b) in "0123456789@=:([" and b < 128)

Span = tuple[int, int, str]


def _emails(text: str) -> list[Span]:
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        local = text[floor:at]
        begin = floor + len(local.rstrip(_LOCAL))
        floor = at + 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((begin, m.end(), "email"))
            floor = m.end()
        at = text.find("@", floor)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    out = _emails(text) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = re.sub("[ -]", "", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def own_candidates(text: str) -> list[Span]:
    keys = [(m.start(), m.end(), "secret") for m in _KEYS.finditer(text)]
    return list(dict.fromkeys(keys + [(m.start(1), m.end(1), kind) for kind, pattern in _OWN.items() for m in pattern.finditer(text)]))


def _words(text: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[^\W\d_]+", text)]


def _listed(kind: str, value: str, after: str) -> int:
    """Whether the lists know what the span is made of, or the place that follows it; of other kinds they say nothing."""
    if kind == "person":
        return 1 if any(w in GIVEN_NAMES for w in _words(value)) else -1
    return 1 if kind == "address" and any(w in PLACES for w in _words(after)) else 0


def _check(kind: str, value: str) -> int:
    if kind == "card":
        return 1 if luhn(re.sub("[ -]", "", value)) else -1
    if kind == "iban":
        flat = value.replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1 else -1
    if kind == "secret":
        if PLACEHOLDERS.search(value):
            return -1
        kinds = sum(bool(re.search(p, value)) for p in ("[0-9]", "[A-Za-z]", "[^A-Za-z0-9]"))
        return 1 if kinds >= 2 and len(set(value)) >= 6 else -1
    if kind == "ssn":
        area, group, serial = value.split("-")
        return -1 if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000" else 1
    return 0


def votes(text: str, span: Span, base: bool) -> tuple[int, ...]:
    begin, end, kind = span
    value, before, after = text[begin:end], text[max(0, begin - CUE_CHARS) : begin].lower(), text[end : end + 1]
    cue = 1 if any(c in before for c in CUES[kind]) else 0
    touching = (before[-1:].isalnum() or after.isalnum()) and kind != "hidden_email"
    shape = base or kind in ("iban", "ssn", "address", "hidden_email") or kind == "secret" and _KEYS.match(text, begin) is not None
    return (1 if shape else 0, _check(kind, value), cue, -1 if touching else 1, -1 if PLACEHOLDERS.search(value) else 0, _listed(kind, value, text[end : end + CUE_CHARS]))


def _length_class(span: Span) -> int:
    return min(3, (span[1] - span[0]) // 10)


Pattern = tuple[int, tuple[int, ...], int]


def pattern(text: str, span: Span, base: bool) -> Pattern:
    return KINDS.index(span[2]), votes(text, span, base), _length_class(span)


def _code(p: Pattern) -> int:
    code = p[0]
    for v in p[1]:
        code = code * 3 + v + 1
    return code * 4 + p[2]


def _decode(code: int) -> Pattern:
    code, size = divmod(code, 4)
    out = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        out.append(v - 1)
    return code, tuple(out[::-1]), size


def candidate_rows(part: Slice) -> list[int]:
    """The texts that can have a candidate at all."""
    worth = part.per_row(_WORTH[part.buf]) > 0
    raw = part.buf.tobytes()
    for start in _STARTS:
        at = raw.find(start)
        while at >= 0:
            row = int(np.searchsorted(part.offs, at, "right")) - 1
            worth[row] = True
            at = raw.find(start, int(part.offs[row + 1]))
    return np.flatnonzero(worth).tolist()


def pattern_counts(docs: DataFrame, text: str = "text") -> dict[int, int]:
    """How often each pattern occurs among all candidates of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(PATTERNS, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                for i in candidate_rows(part):
                    t = part.text(i).decode()
                    for base, spans in ((True, base_spans(t)), (False, own_candidates(t))):
                        for s in spans:
                            counts[_code(pattern(t, s, base))] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["code", "n"])

    rows = docs.select(F.col(f"`{text}`")).mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    return {r.code: r.n for r in rows}


def estimate(counts: dict[int, int]) -> dict[int, float]:
    """The posterior of each pattern, by EM: per kind a prior, per kind and labeler the odds of each vote for true and false spans."""
    out: dict[int, float] = {}
    by_kind: dict[int, list[tuple[int, tuple[int, ...], int]]] = {}
    for code in sorted(counts):
        kind, vote, _ = _decode(code)
        by_kind.setdefault(kind, []).append((code, vote, counts[code]))
    for rows in by_kind.values():
        vote = np.array([v for _, v, _ in rows])
        n = np.array([c for _, _, c in rows], float)
        # begin with the majority of votes
        p = 1 / (1 + np.exp(-vote.sum(1).astype(float)))
        for _ in range(EM_ROUNDS):
            prior = (float((n * p).sum()) + 2) / (float(n.sum()) + 3)
            score = np.full(len(rows), np.log(prior / (1 - prior)))
            for j in range(len(LABELERS)):
                for v in (-1, 1):  # no vote says nothing
                    at = vote[:, j] == v
                    said = vote[:, j] != 0
                    held = BELIEVED[j] if v > 0 else 1 - BELIEVED[j]
                    right = ((n * p)[at].sum() + BELIEVED_FOR * held) / ((n * p)[said].sum() + BELIEVED_FOR)
                    wrong = ((n * (1 - p))[at].sum() + BELIEVED_FOR * (1 - held)) / ((n * (1 - p))[said].sum() + BELIEVED_FOR)
                    score[at] += np.log(right / wrong)
            p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        out |= {code: float(x) for (code, _, _), x in zip(rows, p, strict=True)}
    return out


def _features(code: int) -> np.ndarray:
    kind, vote, size = _decode(code)
    x = np.zeros(1 + len(KINDS) + 2 * len(LABELERS) + 4)
    x[0] = 1
    x[1 + kind] = 1
    for j, v in enumerate(vote):
        if v:
            x[1 + len(KINDS) + 2 * j + (v > 0)] = 1
    x[-4 + size] = 1
    return x


def train(counts: dict[int, int]) -> dict[int, float]:
    """The classifier's probability for every pattern seen, after fitting it to EM's posteriors."""
    if not counts:
        return {}
    target = estimate(counts)
    codes = sorted(counts)
    x, y = np.array([_features(c) for c in codes]), np.array([target[c] for c in codes])
    w = np.log1p(np.array([counts[c] for c in codes], float))  # damped, so that a common pattern doesn't drown the others
    w /= w.sum()
    theta = np.zeros(x.shape[1])
    for _ in range(FIT_ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (w * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + RIDGE * np.eye(len(theta))
        step = np.linalg.solve(hess, x.T @ (w * (y - p)) - RIDGE * theta)
        theta += FIT_STEP * step
        if np.abs(step).max() < 1e-8:
            break
    return {c: float(v) for c, v in zip(codes, 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30))), strict=True)}


def find(text: str, model: dict[int, float]) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans: an added one gives way to base spans that it overlaps."""
    base = base_spans(text)
    begins, ends = [], []  # where base spans stand, those that overlap as one
    for a, b, _ in base:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    added: list[Span] = []
    for s in sorted(own_candidates(text), key=lambda s: (s[0], KINDS.index(s[2]))):
        k = bisect_left(begins, s[1]) - 1  # the last that begins before the span ends
        free = (k < 0 or ends[k] <= s[0]) and not (added and s[0] < added[-1][1])
        if free and model.get(_code(pattern(text, s, False)), 0.0) >= CUT:
            added.append(s)
    return base, sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2])))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def detect(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and each row's counts and spans."""
    model = train(pattern_counts(docs, text))

    def make():
        def compute(part: Slice, _) -> dict:
            base: list[list[Span]] = [[] for _ in range(part.n)]
            spans = list(base)
            for i in candidate_rows(part):
                base[i], spans[i] = find(part.text(i).decode(), model)
            out: dict = {f"n_{k}": [sum(s[2] == k for s in b) for b in base] for k in BASE_KINDS}
            out["base_sha256"] = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            out["spans"] = [_joined(s) for s in spans]
            return out

        return compute

    return map_text(docs, text, keep, FIELDS, make)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans count as one, named after the first."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", count: str | None = None) -> DataFrame:
    """All rows and columns, with the spans of ``text`` masked; ``count``, if given and there, becomes the new number of code points (of a masked text only)."""
    model = train(pattern_counts(docs, text))
    counted = count if count in docs.columns else None
    size = unused(docs.columns, "__count")

    def make():
        def compute(part: Slice, rows: pa.RecordBatch) -> dict:
            texts = [None if null else part.text(i).decode() for i, null in enumerate(part.null)]
            sizes = rows.column(rows.schema.names.index(counted)).to_pylist() if counted else []
            for i in candidate_rows(part):
                spans = find(texts[i], model)[1]
                if spans:
                    texts[i] = masked(texts[i], spans)
                    if counted:
                        sizes[i] = len(texts[i])
            return {text: texts} | ({size: sizes} if counted else {})

        return compute

    fields = f"`{text}` string" + (f", `{size}` {docs.schema[counted].dataType.simpleString()}" if counted else "")
    out = map_text(docs, text, docs.columns, fields, make)
    return out.select(*[F.col(f"`{size}`").alias(c) if c == counted else F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return detect(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def base_query(spark, sf_dir: str) -> DataFrame:
    """What SQL can express of the operator's rows: the spans of the base kinds."""
    return query(spark, sf_dir).drop("spans")


def _base_sql() -> str:
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    # from the right, every second digit counts twice, less 9 if that has two digits
    digit = f"CAST(substr(reverse({digits}), CAST(i AS BIGINT), 1) AS INTEGER)"
    doubled = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN {digit} ELSE 2 * {digit} - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END END))"
    holds = {
        "email": "TRUE", "ip": "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR CAST('0' || right(x, 3) AS INTEGER) > 255)) = 0",
        "card": f"CASE WHEN length({digits}) BETWEEN 14 AND 19 THEN {doubled} % 10 = 0 ELSE FALSE END", "phone": f"length({digits}) BETWEEN 10 AND 15",
    }
    # a match begins behind the pieces between matches before it, and behind these matches
    arms = " UNION ALL ".join(
        f"SELECT k, '{kind}' AS kind, {o} AS o, m, b, b + length(m) AS e FROM (SELECT k, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i: list_sum(list_transform(ps[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))) AS b"
        f" FROM (SELECT k, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS ps FROM d)) WHERE {holds[kind]}"
        for o, (kind, pattern) in enumerate(patterns.items())
    )
    counts = ", ".join(f"CAST(coalesce(n_{kind}, 0) AS BIGINT) AS n_{kind}" for kind in patterns)
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents), s AS ({arms}),
g AS (SELECT k, {", ".join(f"count_if(kind = '{kind}') AS n_{kind}" for kind in patterns)}, string_agg(kind || ':' || CAST(b AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY b, o) AS spans FROM s GROUP BY 1)
SELECT doc_id, {counts}, sha256(coalesce(spans, '')) AS base_sha256 FROM d LEFT JOIN g USING (k)
"""


BASE_SQL = _base_sql()
