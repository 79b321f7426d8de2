"""URL filters: a bit-parallel wildcard automaton over canonical URLs.

A canonical URL is host (A-Z lower-cased) and path. Globs have two wildcards: ``*`` (any run without ``/``) and ``**``
(any run). All globs share one bit vector over several 64-bit words: a bit for each glob's start and one for each literal
byte. A byte ``c`` takes the vector ``D`` to ``((D << 1) & advance[c]) | (D & stay[c])``; a glob matches if its last bit
is set at the end. The vectors of all URLs of a slice move together, one byte position at a time.

Of host rules (``host/path``: the host and its subdomains, paths that start so) the longest wins and decides; else the
blocking globs do; else the URL is allowed.

Edge cases: a null URL, or one without ``://``, has an empty host and path, fits no host rule, and is allowed. Repeated
rows are judged one by one. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import Slice, besides, map_text, unused

#: (rule, verdict)
HOST_RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))
#: Blocking globs over host and path.
GLOBS = ("*casino*", "*casino*/**", "*cheap-pills*", "*cheap-pills*/**", "*free-bets*", "*free-bets*/**", "*spam-farm*", "*spam-farm*/**", "ads-track.*", "ads-track.*/**", "*.ads-track.*", "*.ads-track.*/**", "**/*.exe", "**/wp-login*", "*/**/adult/**")
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class GlobSet:
    """The compiled automaton of some globs."""

    def __init__(self, globs: Sequence[str]):
        bits: list[tuple[int | None, int]] = []  # the byte that leads to each bit (None: a start), its wildcard: 0, 1 or 2
        self.finals: list[int] = []
        for glob in globs:
            raw = glob.encode()
            bits.append((None, 0))
            i = 0
            while i < len(raw):
                if raw[i] == 42:
                    stars = 2 if raw[i : i + 2] == b"**" else 1
                    byte, loop = bits[-1]
                    bits[-1] = (byte, max(loop, stars))
                    i += stars
                else:
                    bits.append((raw[i], 0))
                    i += 1
            self.finals.append(len(bits) - 1)
        self.width = max(1, -(-len(bits) // 64))
        self.start = np.zeros(self.width, np.uint64)
        self.advance = np.zeros((256, self.width), np.uint64)
        self.stay = np.zeros((256, self.width), np.uint64)
        for k, (byte, loop) in enumerate(bits):
            word, bit = k // 64, np.uint64(1 << k % 64)
            if byte is None:
                self.start[word] |= bit
            else:
                self.advance[byte, word] |= bit
            if loop:
                self.stay[:, word] |= bit
                if loop == 1:
                    self.stay[47, word] &= ~bit

    def match(self, part: Slice) -> np.ndarray:
        """For each text and glob, whether the whole text matches."""
        sizes = np.diff(part.offs)
        order = np.argsort(-sizes, kind="stable")
        begin, sizes = part.offs[:-1][order], sizes[order]
        state = np.repeat(self.start[None], part.n, 0)
        one, top = np.uint64(1), np.uint64(63)
        for at in range(int(sizes[0]) if part.n else 0):
            live = int(np.searchsorted(-sizes, -at, "left"))  # those longer than at
            byte = part.buf[begin[:live] + at]
            now = state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.advance[byte]) | (now & self.stay[byte])
        out = np.empty((part.n, len(self.finals)), bool)
        for g, k in enumerate(self.finals):
            out[order, g] = (state[:, k // 64] >> np.uint64(k % 64)) & one != 0
        return out


#: Bytes of rules that make one automaton: a task holds 4 KB for each 64 of them.
RULE_BYTES = 1 << 20


def read_rules(table: DataFrame, most: int = RULE_BYTES) -> tuple[list[tuple[str, str]], list[str]]:
    """Host rules and blocking globs of a table ``rule, verdict, kind`` (host or glob), whose size is checked before it is read. Rows without a rule say nothing."""
    rows = table.filter("rule IS NOT NULL AND rule <> ''").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("rule")), F.lit(0))).first()[0]
    if size > most:
        raise ValueError(f"{size} bytes of rules are too many for one automaton of {most}")
    got = sorted((r.kind, r.rule, r.verdict) for r in rows.collect())
    return [(rule, verdict) for kind, rule, verdict in got if kind == "host"], [rule for kind, rule, _ in got if kind == "glob"]


def host_rule_globs(rule: str) -> tuple[str, str]:
    return f"{rule}**", f"*.{rule}**"


def canonical(url: str) -> tuple:
    """Columns host and path of a URL column."""
    col = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(col, pattern, 1), UPPER, SMALL), F.regexp_extract(col, pattern, 2)


def judge(df: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",), host_rules: Sequence[tuple[str, str]] = HOST_RULES, globs: Sequence[str] = GLOBS) -> DataFrame:
    """``keep``, host, path, the host rule that decides, the globs that match, and the verdict."""
    host, path = canonical(url)
    keep, whole = besides(keep, ("host", "path", "rule", "globs", "verdict")), unused(keep, "__url")
    rows = df.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"), F.concat(host, path).alias(whole))
    longest = sorted(range(len(host_rules)), key=lambda r: -len(host_rules[r][0]))

    def make():
        machine = GlobSet([g for rule, _ in host_rules for g in host_rule_globs(rule)] + list(globs))

        def compute(part: Slice, _) -> dict:
            got = machine.match(part)
            n = len(host_rules)
            rules, hits, verdicts = [], [], []
            for row in got:
                rule = next((r for r in longest if row[2 * r] or row[2 * r + 1]), None)
                rules.append(None if rule is None else host_rules[rule][0])
                hits.append([globs[k] for k in np.flatnonzero(row[2 * n :])])
                verdicts.append(host_rules[rule][1] if rule is not None else "block" if hits[-1] else "allow")
            return {"rule": rules, "globs": [",".join(h) for h in hits], "verdict": verdicts}

        return compute

    return map_text(rows, whole, [*keep, "host", "path"], "rule string, globs string, verdict string", make)


def query(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _regex(glob: str) -> str:
    return "^" + "".join({"**": ".*", "*": "[^/]*"}.get(x) or "".join("\\" + c if c in ".+?()[]{}^$|\\" else c for c in x) for x in _parts(glob)) + "$"


def _parts(glob: str) -> list[str]:
    out, i = [], 0
    while i < len(glob):
        size = 2 if glob[i : i + 2] == "**" else 1
        out.append(glob[i : i + size])
        i += size
    return out


def sql() -> str:
    order = sorted(HOST_RULES, key=lambda r: -len(r[0]))

    def fits(rule: str) -> str:
        host, path = rule.split("/", 1)
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"

    case = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in order) + " END"
    verdict = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in order) + " ELSE CASE WHEN globs <> '' THEN 'block' ELSE 'allow' END END"
    hits = "concat_ws(','," + ", ".join(f"CASE WHEN regexp_matches(host || path, '{_regex(g)}', 's') THEN '{g}' END" for g in GLOBS) + ")"
    return f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), '{UPPER}', '{SMALL}') AS host,
                  regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
r AS (SELECT *, {case} AS rule, {hits} AS globs FROM u)
SELECT page_id, host, path, rule, globs, {verdict} AS verdict FROM r
"""
