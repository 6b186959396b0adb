"""Secret scans: a random forest over candidates removes the false positives.

Candidates are found by form and by what stands around them; whether one is a
secret is decided by the forest alone, from its length, the likelihood of its
character transitions under learned chains, how much of it a dictionary covers,
its path and the words before it.
"""

from __future__ import annotations

import functools
import json
import re
from dataclasses import dataclass, field
from pathlib import Path

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import documents, mark, released

#: Where the dictionary's words come from; the file is read in place and never copied.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: A run of the characters that keys are made of; one with a digit and a letter is a candidate.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-]{12,}={0,2}")
#: What is assigned, of any length and characters; a candidate near a word of FOR.
ASSIGNED = re.compile(r"""[=:]>?\s*(?=(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"'=:>][^\s"']*)))""")
#: What a sentence says of a word of FOR, quoted or not.
SAID = re.compile(r"""\s(?:is|was|are|equals|becomes|->)\s+(?=(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"']+)))""")
#: A private key over several lines.
BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----")
#: The password of a URL.
IN_URL = re.compile(r"://[^\s/@:]*:([^\s/@]+)@")
#: Words before a candidate that speak for, and against, a secret.
FOR = "password passwd passphrase pwd secret token key apikey api_key access_key secret_key private_key auth authorization bearer credential credentials client_secret".split()
AGAINST = "example sample dummy placeholder test fixture sha sha1 sha256 md5 checksum hash digest commit revision uuid guid id isbn version build order invoice ticket url path file image".split()
#: Openings of keys whose form is published by their issuers.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "pk_live_", "rk_live_", "AIza", "SG", "npm_", "pypi-", "hf_", "eyJ")
FEATURES = ("length", "digits", "uppers", "symbols", "hex", "entropy", "changes", "surprise", "likelihood", "repeats", "dictionary", "known_prefix", "for_near", "for_far", "against", "assigned", "quoted", "path_against", "groups", "in_url", "spaces", "block")


@dataclass(frozen=True)
class Finding:
    """A candidate with its surroundings; `secret` where it is labelled."""

    value: str
    before: str
    after: str = ""
    path: str = ""
    secret: bool | None = None


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


_word = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


@functools.cache
def dictionary(path: str = VOCABULARY, least: int = 4) -> tuple[str, ...]:
    """Whole words of at least `least` letters in the file of a word tokenizer."""
    ending = "</w>"
    words = (t[: -len(ending)] for t in json.loads(Path(path).read_text(encoding="utf-8"))["model"]["vocab"] if t.endswith(ending))
    return tuple(sorted(w for w in words if len(w) >= least and w.isascii() and w.isalpha()))


#: Characters that a chain tells apart: printable ASCII, and one for all others.
CHARS = 96


def _codes(value: str) -> np.ndarray:
    code = np.frombuffer(value.encode("latin-1", "replace"), np.uint8).astype(np.int64) - 32
    return np.where((code < 0) | (code >= CHARS), CHARS - 1, code)


def chain(values, smooth: float = 0.5) -> np.ndarray:
    """log P(next character | character), learned from the transitions in values."""
    counts = np.full((CHARS, CHARS), smooth)
    for v in values:
        c = _codes(v)
        np.add.at(counts, (c[:-1], c[1:]), 1)
    return np.log(counts / counts.sum(1, keepdims=True))


@dataclass
class Known:
    """What features are made with: a dictionary, the chain of its words, and those of
    labelled secrets and of labelled others. Some hundred kilobytes, whatever the input."""

    words: tuple[str, ...]
    of_words: np.ndarray
    of_secrets: np.ndarray
    of_others: np.ndarray
    _machine: ahocorasick.Automaton | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_machine": None}

    def covered(self, value: str) -> int:
        """Characters inside words of the dictionary, each time the longest that begins leftmost."""
        if self._machine is None:
            self._machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for w in self.words:
                self._machine.add_word(w, len(w))
            self._machine.make_automaton()
        return sum(n for _, n in self._machine.iter_long(value.lower()))


def features(f: Finding, known: Known) -> list[float]:
    v = f.value
    n = len(v)
    kinds = [_kind(c) for c in v]
    code = _codes(v)
    count = np.bincount(code, minlength=1)
    share = count[count > 0] / n
    near = [w.lower() for w in _word.findall(f.before[-60:])]
    last = near[-1:] + [p for w in near[-1:] for p in w.split("_")]
    path = set(_word.findall(f.path.lower()))
    steps = code[:-1], code[1:]
    mean = lambda x: float(x.mean()) if len(x) else 0.0
    return [
        n, kinds.count(0) / n, kinds.count(2) / n, kinds.count(3) / n,
        float(re.fullmatch(r"[0-9a-fA-F]+", v) is not None), float(-(share * np.log2(share)).sum()),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n, -mean(known.of_words[steps]), mean(known.of_secrets[steps] - known.of_others[steps]),
        mean(code[:-1] == code[1:]), known.covered(v) / n,
        float(v.startswith(PREFIXES)), float(any(w in FOR for w in last)), float(any(p in FOR for w in near[-5:] for p in (w, *w.split("_")))),
        float(any(p in AGAINST for w in near[-3:] for p in (w, *w.split("_")))), float(re.search(r"[=:]\s*[\"']?$", f.before) is not None),
        float(f.before[-1:] in "\"'" and f.after[:1] in "\"'" if f.before else False), float(bool(path & set(AGAINST))),
        float(len(re.split(r"[-_/+]", v))), float(re.search(r"://[^\s/@:]*:$", f.before) is not None), v.count(" ") / n, float(v.startswith("-----BEGIN")),
    ]


class Forest:
    """Decision trees on bootstrap samples; each split looks at some features only."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]):
        self.trees = trees

    @classmethod
    def train(cls, x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 9, least: int = 3, seed: int = 5) -> Forest:
        rng = np.random.default_rng(seed)
        return cls([cls._tree(x, y, rng.integers(0, len(x), len(x)), depth, least, rng) for _ in range(trees)])

    @staticmethod
    def _tree(x, y, rows, depth, least, rng) -> tuple[np.ndarray, ...]:
        feature, limit, left, right, value = [], [], [], [], []
        tries = max(1, round(x.shape[1] ** 0.5)) + 1

        def grow(rows: np.ndarray, depth: int) -> int:
            me, p = len(feature), float(y[rows].mean())
            for a, v in ((feature, -1), (limit, 0.0), (left, 0), (right, 0), (value, p)):
                a.append(v)
            if depth and 0 < p < 1 and len(rows) >= 2 * least:
                best = (p * (1 - p) * len(rows) - 1e-9, None, None)
                for f in rng.choice(x.shape[1], tries, replace=False):
                    v = x[rows, f]
                    order = np.argsort(v, kind="stable")
                    v, t = v[order], np.cumsum(y[rows][order])
                    at = np.flatnonzero(v[1:] > v[:-1]) + 1
                    at = at[(at >= least) & (at <= len(rows) - least)]
                    if len(at):
                        a, b, n = t[at - 1], t[-1] - t[at - 1], len(rows)
                        loss = a * (1 - a / at) + b * (1 - b / (n - at))
                        k = int(loss.argmin())
                        if loss[k] < best[0]:
                            best = (float(loss[k]), int(f), float(v[at[k] - 1] + v[at[k]]) / 2)
                if best[1] is not None:
                    low = x[rows, best[1]] <= best[2]
                    feature[me], limit[me] = best[1], best[2]
                    left[me] = grow(rows[low], depth - 1)
                    right[me] = grow(rows[~low], depth - 1)
            return me

        grow(rows, depth)
        return np.array(feature), np.array(limit), np.array(left), np.array(right), np.array(value)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean share of secrets in the leaves."""
        out = np.zeros(len(x))
        for feature, limit, left, right, value in self.trees:
            at = np.zeros(len(x), int)
            while (go := np.flatnonzero(feature[at] >= 0)).size:
                node = at[go]
                at[go] = np.where(x[go, feature[node]] <= limit[node], left[node], right[node])
            out += value[at]
        return out / max(1, len(self.trees))


def labelled_findings(n: int = 6000, seed: int = 11) -> list[Finding]:
    """Findings with labels, made by rule: keys of published forms and random
    values behind words for secrets; and what scanners take for them: digests,
    identifiers, paths, versions, placeholders, words with digits."""
    rng = np.random.default_rng(seed)
    pick = lambda seq: seq[int(rng.integers(len(seq)))]
    chars = lambda alphabet, n: "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))
    words = dictionary()
    low, up, dig, hexa = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    prose = lambda k: " ".join(pick(words) if rng.random() < 0.5 else chars(low, int(rng.integers(2, 9))) for _ in range(k))
    gap = lambda: pick([" = ", "=", ": ", ":", " is ", " ", ' = "', "='", '": "'])
    out = []
    for _ in range(n):
        secret = bool(rng.random() < 0.5)
        kind, path = int(rng.integers(6)), pick(["src3", "src11", "docs", "config", "app/settings", "web"])
        before = prose(6) + " "
        if secret:
            value = [lambda: "AKIA" + chars(up + dig, 16), lambda: pick(["ghp_", "gho_", "glpat-", "hf_", "npm_", "sk_live_"]) + chars(low + up + dig, int(rng.integers(20, 41))), lambda: chars(hexa, int(rng.integers(16, 65))), lambda: chars(low + up + dig, int(rng.integers(12, 49))), lambda: chars(low + up + dig + "+/", int(rng.integers(20, 65))), lambda: chars(low + up + dig + "_-", int(rng.integers(16, 44)))][kind]()
            if kind >= 2 or rng.random() < 0.3:
                before += pick(FOR) + gap()
        else:
            value = [lambda: chars(hexa, pick([32, 40, 64])), lambda: "-".join(chars(hexa, k) for k in (8, 4, 4, 4, 12)), lambda: "/".join(pick(words) for _ in range(int(rng.integers(2, 5)))) + "/" + chars(dig, int(rng.integers(1, 7))), lambda: pick(["x", "X", "0", "1", "a", "abc", "123"]) * 8 + chars(dig, 4) + "x", lambda: "-".join([pick(words), pick(words), chars(dig, int(rng.integers(1, 5)))]), lambda: chars(low, int(rng.integers(9, 22))) + chars(dig, int(rng.integers(1, 5)))][kind]()
            if kind < 2 or rng.random() < 0.3:
                before += pick(AGAINST) + gap()
            elif kind == 3 and rng.random() < 0.6:
                before += pick(FOR) + gap()
            if rng.random() < 0.2:
                path = pick(["test", "example", "fixture"])
        after = before[-1:] if before[-1:] in "\"'" else " " + prose(2)
        if len(value) >= 12:
            out.append(Finding(value, before, after, path, secret))
    size = lambda a, b: int(rng.integers(a, b))
    base64 = low + up + dig + "+/"
    for _ in range(n // 2):  # what is assigned: passwords of any form, and what stands in their place
        secret, kind = bool(rng.random() < 0.5), size(0, 6)
        before, after = prose(4) + " " + pick(["", "db_", "my_"]) + pick(FOR) + pick(["=", ": ", ":", " = ", ' = "', '="', '": "', " = '", " is ", " was "]), " " + prose(2)
        if secret:
            value = [lambda: chars(low + up, size(1, 5)) + pick("!@#$%&*?.") + chars(low + up + dig, size(3, 14)) + chars(dig, 1), lambda: chars(low, size(4, 9)) + chars(dig, size(1, 4)) + chars(low + dig, size(0, 4)), lambda: chars(low, size(16, 33)) if rng.random() < 0.5 else "".join(pick(words) for _ in range(size(3, 6))), lambda: chars(up, 1) + chars(low + dig, size(3, 9)) + chars(dig, size(1, 3)) + chars(low + "!?", size(0, 4)), lambda: chars(low + up + dig + "!@#$%", size(8, 21)), lambda: chars(base64, size(200, 2000))][kind]()
            if rng.random() < 0.25 and kind < 5:
                before, after = prose(4) + " " + pick(["postgres", "https", "mysql", "redis", "amqp"]) + "://" + chars(low, size(3, 9)) + ":", "@" + chars(low, 5)
        else:
            value = [lambda: pick(words) if rng.random() < 0.7 else pick(["none", "null", "true", "false", "required", "None", "True", "changeme", "your_" + pick(FOR), "<" + pick(FOR) + ">", "xxxx"]), lambda: chars(low, size(1, 11)), lambda: chars(dig, size(1, 7)), lambda: pick(["self." + chars(low, 6), chars(low, 5) + "(" + chars(low, 4) + ")", "${" + chars(up, 8) + "}", "<" + chars(low, 7) + ">", "*" * size(3, 12), "x" * size(3, 12), "..."]), lambda: prose(size(2, 9)), lambda: pick(["https://", "//"]) + chars(low, size(4, 10)) + ".com/" + pick(words)][kind]()
            if rng.random() < 0.15:
                value, before = chars(base64, size(200, 2000)), prose(4) + " " + pick(AGAINST) + pick(["=", ": ", " "])
        if secret and rng.random() < 0.05:
            value, before = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(chars(base64, 64) for _ in range(size(2, 20))) + "\n-----END PRIVATE KEY-----", prose(3) + "\n"
        out.append(Finding(value, before, before[-1] if before[-1] in "\"'" else after, pick(["src3", "docs", "config"]), secret))
    return out


@dataclass
class Model:
    known: Known
    forest: Forest

    def scores(self, findings: list[Finding]) -> list[float]:
        return self.forest.predict(np.array([features(f, self.known) for f in findings])).tolist() if findings else []


_models: dict[tuple[int, int, str], Model] = {}


def findings_of(table: DataFrame) -> list[Finding]:
    """Labelled findings of a table (value, before, after, path, secret); a null label or
    value is left out. They go to the driver: labels made by people, not a corpus."""
    rows = table.where("value is not null and value <> '' and secret is not null").select("value", "before", "after", "path", "secret").toLocalIterator()
    return [Finding(r[0], r[1] or "", r[2] or "", r[3] or "", bool(r[4])) for r in rows]


def trained(findings: list[Finding] | None = None, n: int = 6000, seed: int = 11, vocabulary: str = VOCABULARY) -> Model:
    """A model trained on labelled findings; without any, on those made by rule (kept
    between calls). The chains learn from every second finding and the forest from
    the others, so that it does not trust them too much."""
    key = (n, seed, vocabulary)
    if findings is None and key in _models:
        return _models[key]
    used = findings if findings is not None else labelled_findings(n, seed)
    words, first = dictionary(vocabulary), used[::2]
    known = Known(words, chain(words), chain(f.value for f in first if f.secret), chain(f.value for f in first if not f.secret))
    second = used[1::2] or first
    made = Model(known, Forest.train(np.array([features(f, known) for f in second]), np.array([float(bool(f.secret)) for f in second])))
    if findings is None:
        _models[key] = made
    return made


def near_key(before: str, words: int = 5) -> bool:
    return any(p in FOR for w in _word.findall(before[-60:])[-words:] for p in (w.lower(), *w.lower().split("_")))


def candidates(text: str, path: str) -> list[tuple[int, int, Finding]]:
    """Runs of key characters, what is assigned to or said of a word of FOR, passwords
    of URLs, private keys over several lines; by place. One may lie inside another."""
    spans = {m.span() for m in CANDIDATE.finditer(text) if any(c.isdigit() for c in m.group()) and any(c.isalpha() for c in m.group())}
    for form, near in ((ASSIGNED, near_key), (SAID, lambda before: near_key(before, 1))):
        for m in form.finditer(text):
            if near(text[max(0, m.start() - 80) : m.start()]):
                a, b = m.span(m.lastindex)
                spans.add((a, b if m.lastindex < 3 else a + max(1, len(m.group(3).rstrip(".,;)]}")))))
    spans |= {m.span(1) for m in IN_URL.finditer(text)} | {m.span() for m in BLOCK.finditer(text)}
    return [(a, b, Finding(text[a:b], text[max(0, a - 80) : a], text[b : b + 8], path)) for a, b in sorted(spans)]


def joined(hits: list[dict]) -> list[dict]:
    """Overlapping hits as one, with the greatest score."""
    out: list[dict] = []
    for h in hits:
        if out and h["start"] < out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], h["end"]), "score": max(out[-1]["score"], h["score"])}
        else:
            out.append(h)
    return out


FOUND = T.StructType([T.StructField("n_candidates", T.LongType()), T.StructField("secrets", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))), T.StructField("redacted", T.StringType())])
_ARROW = pa.struct([("n_candidates", pa.int64()), ("secrets", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))), ("redacted", pa.string())])
MARK = "[SECRET]"


def scan_secrets(docs: DataFrame, model: Model | None = None, least: float = 0.5, text: str = "text", path: str = "source", out: str = "found") -> DataFrame:
    """docs with a struct: n_candidates, secrets (start, end in characters, score), redacted.

    redacted is the text with each secret replaced by a mark, null where there
    is none. A null or empty text has no candidates, texts of any length are
    scanned whole; a null path says nothing. Overlapping secrets are one; repeated
    rows get equal results; an empty table stays empty. A column named `out` is
    replaced, all others pass through. Nothing is shuffled; the model (some
    hundred kilobytes, whatever the input) goes to the executors. It may come from
    findings labelled by others: trained(findings_of(table)).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or trained())
    names = [c for c in docs.columns if c.lower() != out.lower()]
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField(out, FOUND)])

    def run(batches):
        model = shared.value
        for b in batches:
            texts, paths = (b.column(b.schema.get_field_index(c)).to_pylist() for c in (text, path))
            found = [candidates(t or "", p or "") for t, p in zip(texts, paths, strict=True)]
            scores = iter(model.scores([f for per in found for *_, f in per]))
            rows = []
            for t, per in zip(texts, found, strict=True):
                hits = joined([{"start": a, "end": e, "score": s} for (a, e, _), s in zip(per, (next(scores) for _ in per), strict=True) if s >= least])
                clean, at = [], 0
                for h in hits:
                    clean += [t[at : h["start"]], MARK]
                    at = h["end"]
                rows.append({"n_candidates": len(per), "secrets": hits, "redacted": "".join([*clean, t[at:]]) if hits else None})
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(rows, _ARROW)], [*names, out])

    return docs.mapInArrow(released(run), schema)


def redact(docs: DataFrame) -> DataFrame:
    """docs with the secrets in their texts replaced; same columns, whatever their
    names, n_chars as of the new text. A null or empty text stays as it is; texts
    of any length are scanned whole; every row stays, repeated ones with equal new
    texts; an empty table stays empty."""
    held = mark(docs.columns) + "found"
    scanned, text = scan_secrets(docs, out=held), F.col(f"{held}.redacted")
    new = {"text": F.coalesce(text, "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(text.isNull(), F.col("n_chars")).otherwise(F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return scanned.withColumns(new).select(*docs.columns)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return found.select("doc_id", "found.n_candidates", F.size("found.secrets").cast("long").alias("n_secrets"), F.col("found.secrets").alias("secrets"), F.sha2(F.coalesce("found.redacted", "text", F.lit("")), 256).alias("redacted_sha256"))
