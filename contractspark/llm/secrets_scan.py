"""Secret scans: known shapes, and strings that a language vocabulary spends many tokens on.

Base shapes (leftmost, non-overlapping per kind): an assignment to a secret's name, an access key id, a run of hex digits.
The method looks at every other run of key characters: its characters per token under a byte-pair vocabulary (tiktoken)
are high for words and low for random strings, so a run of ``least`` characters or more below ``ratio`` is a finding of
kind ``random``, unless it is a known digest (hex of a digest's length), a UUID, or an identifier: words and numbers, alone
or joined by ``_ - / . =``, whose letters the vocabulary splits into words (``letters`` characters a token or more; compound
words have fewer than other text, so this limit is below ``ratio``).

A map over documents in Arrow batches; the vocabulary's path is a parameter and must exist on the executors. Tokens of a
run are counted in slices of 400 characters, so a very long run costs linear time.

Defined cases: null text is empty and has no findings; repeated rows are scanned each; null ids are carried; an empty
table gives no rows. ``documents`` columns are carried (or those in ``keep``); ``secrets`` replaces a column of that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractspark.llm.common import without

#: Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
NAMES = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)

RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Hex lengths of common digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGESTS = (32, 40, 56, 64, 96, 128)
PART = re.compile(r"[A-Z]+[a-z]*|[a-z]+|[0-9]+")

RESULT = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind); a match that is too short is dropped, and what it covered stays covered."""
    found = []
    if NAMES.search(text):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def is_known(run: str, of: TokenRatio, letters: float) -> bool:
    """A digest, a UUID or an identifier. Parts of fewer than four letters say nothing; long ones are judged each."""
    if UUID.fullmatch(run) or (len(run) in DIGESTS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run)):
        return True
    parts = [p for p in re.split(r"[_/=.+-]+", run) if p]
    if not all(p.isalpha() or p.isdigit() or re.fullmatch(r"[A-Za-z]+[0-9]{1,4}", p) for p in parts):
        return False
    words = [w for p in parts if len(w := p.rstrip("0123456789")) >= 4]
    ratios = [of(w) for w in words]
    if any(len(w) >= 8 and r < letters for w, r in zip(words, ratios)):
        return False
    return not words or sum(map(len, words)) >= letters * sum(len(w) / r for w, r in zip(words, ratios))


class TokenRatio:
    """Characters per token of a string."""

    def __init__(self, ranks_path: str, pattern: str):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, run: str) -> float:
        return len(run) / max(1, sum(len(self.coder.encode_ordinary(run[i:i + 400])) for i in range(0, len(run), 400)))


def random_spans(text: str, base: list[tuple[int, int, str]], of: TokenRatio, least: int, ratio: float, letters: float, run: re.Pattern) -> list[tuple[int, int, str]]:
    """Runs outside the base spans that the vocabulary finds no words in."""
    found = []
    taken = sorted(base)
    for m in run.finditer(text):
        s, e = m.span()
        while e - s >= least and text[e - 1] in "=-_/+":
            e -= 1
        while e - s >= least and text[s] in "=-_/+":
            s += 1
        own = text[s:e]
        if e - s >= least and not any(a < e and s < b for a, b, _ in taken) and not is_known(own, of, letters) and of(own) < ratio:
            found.append((s, e, "random"))
    return found


def scan(docs: DataFrame, ranks_path: str, pattern: str, *, text_col: str = "text", least: int = 16, ratio: float = 2.2,
         letters: float = 1.9, keep: list[str] | None = None, result: str = "secrets") -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``result``: findings (kind, start, end) in code points, by start then kind."""
    own = "__text"
    src = docs.withColumn(own, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    src = without(src, result) if keep is None else src.select(*[F.col(f"`{c}`") for c in keep], own)
    carried = [f.name for f in src.schema.fields[:-1]]
    at = src.columns.index(own)

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, run = None, re.compile(RUN.pattern[:-1] + "{%d,}" % least)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            of = of or TokenRatio(ranks_path, pattern)
            rows = []
            for text in (x.as_py() for x in batch.column(at)):
                base = base_spans(text)
                spans = base + random_spans(text, base, of, least, ratio, letters, run)
                rows.append([{"kind": k, "start": s, "end": e} for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))])
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), pa.array(rows, kind)], [*carried, result])

    return src.mapInArrow(in_task, T.StructType([*src.schema.fields[:-1], T.StructField(result, RESULT)]))
