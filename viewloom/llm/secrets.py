"""Secret scan: candidates by shape, false positives removed by a random forest."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.common import with_columns
from viewloom.session import materialize

#: A candidate is a run of these characters of at least SHORTEST, with a digit or with capitals inside.
SHORTEST = 16
_RUN = re.compile(rf"[A-Za-z0-9+/=_\-.~]{{{SHORTEST},}}")
_MIXED = re.compile(r"[0-9]|[a-z][A-Z]|[A-Z]{2}[a-z]")
_ASSIGNED = re.compile(r"[A-Za-z_.\-]+=+(?=[^=])")
#: Behind an assignment or a secret word any value without spaces of this length is a candidate.
BRIEFEST = 6
_GIVEN = re.compile(
    r"(?<![\w.\-])(?:[A-Za-z_][\w.\-]*[\"'`]?\s{0,3}(?P<sign>[:=]>?|:=)\s{0,3}"
    r"|(?i:token|secret|password|passwd|passphrase|pwd|api[_\-]?key|key|bearer|credentials?)\s{1,3})"
    rf"(?:(?P<quote>[\"'`])(?P<quoted>[^\s\"'`]{{{BRIEFEST},}})(?P=quote)|(?P<bare>[^\s\"'`<>]{{{BRIEFEST},}}))"
)
#: Characters looked at on each side of a candidate, and what replaces a secret.
CONTEXT, MASK = 48, "[SECRET]"
#: Words next to secrets, and next to identifiers that are none.
SECRET_WORDS = frozenset("token secret password passwd pwd apikey api key auth authorization bearer credential credentials private access".split())
PLAIN_WORDS = frozenset("commit sha sha1 sha256 md5 hash digest checksum uuid guid revision rev id version href src url path file image build etag integrity".split())
#: A word belongs to the dictionary if it stands in at least this share of all documents: its size is bounded by the words of a document.
COMMON = 2e-3
#: Different words that a task holds before it sends its counts.
HELD = 1 << 17
#: Bound of the documents from which labelled findings are made, trees and depth of the forest, probability from which a finding is a secret.
FINDINGS, TREES, DEPTH, ENOUGH = 600, 24, 8, 0.5

_LETTERS = re.compile(r"[^\W\d_]{3,}")
FEATURES = 20


# --- candidates ---------------------------------------------------------------------------------------------------------


def candidates(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the runs in a whole text that may be a secret; none for null and empty texts.

    Names and quotes in front of an assignment are not part of the run, nor are dots and dashes at its ends. A shorter value, or one of other
    characters, is a candidate behind an assignment or a secret word; it takes the place of runs that are only part of it.
    """
    found = _runs(text)
    given = list(_values(text or ""))
    if not given:
        return found
    merged, k = [], 0
    for i, j, whole in given:
        while k < len(found) and found[k][1] <= i:
            merged.append(found[k])
            k += 1
        last = k
        while last < len(found) and found[last][0] < j:
            last += 1
        inside = found[k:last]
        if not inside or whole and i <= inside[0][0] and inside[-1][1] <= j:
            merged.append((i, j))
        else:
            merged += inside
        k = last
    return merged + found[k:]


def _values(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whether it is taken whole) of values behind an assignment or a secret word."""
    at = 0
    while m := _GIVEN.search(text, at):
        kind = "quoted" if m["quoted"] else "bare"
        i, j = m.span(kind)
        at = m.end()
        if kind == "bare":
            if text.startswith("//", i):
                continue
            later = re.search(r"[=:](?=[^=])", m["bare"])
            if m["sign"] is None and later:  # the value is an assignment itself
                at = i
                continue
            j = i + len(m["bare"].rstrip(".,;:!?)]}"))
        if j - i >= BRIEFEST:
            yield i, j, kind == "quoted" or m["sign"] == ":"


def _runs(text: str | None) -> list[tuple[int, int]]:
    found = []
    for m in _RUN.finditer(text or ""):
        run, at = m[0], m.start()
        cut = _ASSIGNED.match(run)
        if cut and len(run) - cut.end() >= SHORTEST:
            run, at = run[cut.end() :], at + cut.end()
        lead = len(run) - len(run.lstrip(".-=/"))
        run, at = run[lead:].rstrip(".-"), at + lead
        if len(run) >= SHORTEST and _MIXED.search(run):
            found.append((at, at + len(run)))
    return found


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(text: str, start: int, end: int, dictionary: frozenset[str]) -> list[float]:
    """Length, character transitions, dictionary coverage, path and neighbouring words of one candidate."""
    run = text[start:end]
    n = len(run)
    kinds = [_class(c) for c in run]
    shares = [kinds.count(k) / n for k in range(4)]
    moves = sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1)
    to_digit = sum(a != 2 and b == 2 for a, b in zip(kinds, kinds[1:])) / max(1, n - 1)
    counts = np.array(list(_counts(run).values())) / n
    entropy = float(-(counts * np.log2(counts)).sum())
    hexadecimal = sum(c in "0123456789abcdefABCDEF" for c in run) / n
    vowels = sum(c in "aeiouAEIOU" for c in run) / n
    repeats = sum(a == b for a, b in zip(run, run[1:])) / max(1, n - 1)
    parts = _LETTERS.findall(run)
    covered = sum(len(p) for p in parts if p.lower() in dictionary) / n
    longest = max(map(len, parts), default=0)
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    near = re.findall(r"[a-z0-9]+", before.lower())[-3:]
    quoted = before[-1:] in "\"'`" and before[-1:] != "" and after[:1] == before[-1:]
    assigned = bool(re.search(r"[:=]\s*[\"'`]?$", before))
    path = run.count("/") + run.count(".") + (before[-1:] in ("/", ".", "@")) + 3 * bool(re.search(r"(?:https?|ftp|file)://\S*$", before))
    dashed = bool(re.fullmatch(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", run))
    return [
        float(n), *shares, moves, to_digit, entropy, hexadecimal, vowels, repeats, covered, float(longest),
        float(any(w in SECRET_WORDS for w in near)), float(any(w in PLAIN_WORDS for w in near)),
        float(quoted), float(assigned), float(path), float(dashed), run.count("_") / n,
    ]


def _counts(run: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for c in run:
        found[c] = found.get(c, 0) + 1
    return found


# --- dictionary ---------------------------------------------------------------------------------------------------------


def dictionary(docs: DataFrame, text: str = "text") -> frozenset[str]:
    """Words of three letters and more that stand in at least ``COMMON`` of all documents, in lower case."""
    rows = docs.select(F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        total = 0

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for body in batch.column(0).to_pylist():
                total += 1
                for word in set(_words(body)):
                    counts[word] = counts.get(word, 0) + 1
                if len(counts) > HELD:
                    yield flush()
        yield flush()
        yield pa.RecordBatch.from_arrays([pa.array([""], pa.string()), pa.array([total], pa.int64())], names=["word", "n"])

    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "words")
    total = counted.where("word = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return frozenset(r[0] for r in counted.where((F.col("word") != "") & (F.col("n") >= max(2.0, COMMON * total))).select("word").collect())


def _words(text: str | None) -> list[str]:
    return [w for w in text.lower().split() if len(w) > 2 and w.isalpha()] if text else []


# --- labelled findings --------------------------------------------------------------------------------------------------

#: Contexts of labelled findings: {v} is the value, {w} a word of the document.
POSITIVE = (
    'token = "{v}"', "api_key={v}", "password: '{v}'", "Authorization: Bearer {v}", 'secret_key = "{v}"', "export ACCESS_TOKEN={v}", '{w} auth_token: "{v}" {w}',
    "client_secret={v}&{w}", "key {v} {w}", "{w} token {v}", '"private_key": "{v}"', "TOKEN = \"{v}\"!!", "passwd={v}", "AWS_SECRET_ACCESS_KEY={v}",
)
NEGATIVE = (
    "commit {v}", "sha256:{v}", "{w} md5 {v} {w}", "checksum = {v}", "https://example.com/{w}/{v}", "/usr/lib/{w}/{v}.so", 'href="{v}"', "revision {v} {w}",
    "uuid: {v}", "{w} {v} {w}", "file {w}/{v}", "etag: \"{v}\"", "build {v}", "image: {w}@{v}",
)


#: Contexts of short values, and of short values that are none.
BRIEF_POSITIVE = ("password: {v}", "password: '{v}'", "passwd: {v}", 'pwd = "{v}"', "api_key={v}", 'token: "{v}"', "secret {v} {w}", "passwd={v}")
BRIEF_NEGATIVE = ("{w}: {v}", '{w} = "{v}"', "count: {v}", "id={v}", "key {v} {w}", "commit: {v}", "time: {v}")


def _brief(kind: int, digest: bytes, words: list[str]) -> str:
    import base64

    hexed = hashlib.sha512(digest).hexdigest()
    number = str(int(hexed, 16))
    word = min(words, key=lambda w: (abs(len(w) - 6), w))[:10]
    if kind == 0:
        return base64.b64encode(hashlib.sha384(digest).digest(), b"xY").decode()[: 8 + digest[1] % 8]
    if kind == 1:
        leet = word.capitalize().translate(str.maketrans("aeio", "4310"))
        return f"{leet}{'!@#$%&*'[digest[2] % 7]}{number[: 1 + digest[3] % 4]}".rjust(BRIEFEST + 2, "T")
    if kind == 2:
        return f"{word.lower()}{number[: 1 + digest[3] % 4]}{words[1][:8].lower()}".ljust(BRIEFEST + 2, "7")
    if kind == 3:
        return number[: BRIEFEST + digest[3] % 6]
    if kind == 4:
        return f"{number[:2]}:{number[2:4]}:{number[4:6]}"
    joined = word if len(word) >= BRIEFEST else f"{word}-{words[1]}"
    return joined.ljust(BRIEFEST, "e")


def _value(kind: int, digest: bytes, words: list[str]) -> str:
    import base64

    hexed = hashlib.sha512(digest).hexdigest()
    if kind == 0:
        return hexed[: 32 + 8 * (digest[0] % 5)]
    if kind == 1:
        return base64.b64encode(hashlib.sha384(digest).digest()).decode()[: 20 + digest[1] % 44]
    if kind == 2:
        return hexed[:40].upper()
    if kind == 3:
        return ("AKIA", "ghp_", "sk_live_", "xoxb-")[digest[2] % 4] + base64.b32encode(hashlib.sha256(digest).digest()).decode()[: 16 + digest[3] % 20]
    if kind == 7:
        return str(int(hexed, 16))[: SHORTEST + digest[5] % 8]
    if kind == 4:
        return f"{hexed[:8]}-{hexed[8:12]}-{hexed[12:16]}-{hexed[16:20]}-{hexed[20:32]}"
    joined = "".join(w.capitalize() if kind == 5 else f"{w}_" for w in words)[:60].strip("_")
    return (joined + str(digest[4]) if kind == 6 else joined).ljust(SHORTEST, "x")


def labelled_findings(docs: DataFrame, key: str = "doc_id", text: str = "text", bound: int = FINDINGS) -> DataFrame:
    """(text, start, end, label): labelled findings made from at most ``bound`` documents, chosen by a hash of the key.

    A document gives its words as surroundings. Findings labelled 1 are random values (hexadecimal, base64, prefixed keys) where a secret is assigned;
    findings labelled 0 are the same values as checksums, revisions and parts of paths, identifiers, and words of the document run together, in any place.
    """
    rows = docs.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("draw"))
    # the draws are chosen without their texts; repeated rows draw alike and count once
    draws = rows.select("draw").distinct().orderBy("draw").limit(bound)
    chosen = rows.join(F.broadcast(draws), "draw").groupBy("draw").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, draw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = re.findall(r"[^\W\d_]+", body) or ["text"]
                for label, frames in ((1, POSITIVE), (0, NEGATIVE)):
                    for n, frame in enumerate(frames):
                        digest = hashlib.sha256(f"{draw}:{label}:{n}".encode()).digest()
                        some = [words[b % len(words)] for b in digest[8:14]]
                        kinds = (0, 0, 1, 2, 3, 0, 1) if label else (0, 0, 1, 2, 4, 5, 6, 7)
                        value = _value(kinds[digest[7] % len(kinds)], digest, some)
                        left = " ".join(some) + " " + frame.replace("{w}", some[0])
                        at = left.index("{v}")
                        out.append((left.replace("{v}", value) + " " + some[1], at, at + len(value), label))
                # an identifier or joined words stay harmless where a secret would stand
                for n, frame in enumerate(POSITIVE):
                    digest = hashlib.sha256(f"{draw}:words:{n}".encode()).digest()
                    some = [words[b % len(words)] for b in digest[8:14]]
                    value = _value(5 + n % 3, digest, some)
                    left = " ".join(some) + " " + frame.replace("{w}", some[0])
                    at = left.index("{v}")
                    out.append((left.replace("{v}", value) + " " + some[1], at, at + len(value), 0))
                for label, frames, chosen_kinds in ((1, BRIEF_POSITIVE, (0, 1, 2)), (0, BRIEF_POSITIVE, (5, 5, 4)), (0, BRIEF_NEGATIVE, (3, 4, 5))):
                    for n, frame in enumerate(frames):
                        digest = hashlib.sha256(f"{draw}:brief:{label}:{n}:{frame}".encode()).digest()
                        some = [words[b % len(words)] for b in digest[8:14]]
                        value = _brief(chosen_kinds[digest[7] % 3], digest, some)
                        left = " ".join(some) + " " + frame.replace("{w}", some[0])
                        at = left.index("{v}")
                        out.append((left.replace("{v}", value) + " " + some[1], at, at + len(value), label))
            if out:
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["text", "start", "end", "label"])

    return chosen.select("text", "draw").mapInArrow(run, "text string, start int, end int, label int")


# --- forest -------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays: the feature asked (-1 in a leaf), its threshold, the nodes for "not greater" and "greater", the vote of a leaf."""

    feature: list[int]
    threshold: list[float]
    lower: list[int]
    upper: list[int]
    vote: list[float]

    def __call__(self, values: list[float]) -> float:
        node = 0
        while self.feature[node] >= 0:
            node = self.lower[node] if values[self.feature[node]] <= self.threshold[node] else self.upper[node]
        return self.vote[node]


def _tree(described: str) -> Tree:
    """A trained tree from its description, which names every question in full."""
    lines = iter(described.strip().split("\n")[1:])
    tree = Tree([], [], [], [], [])

    def grow() -> int:
        line = next(lines).strip()
        node = len(tree.feature)
        for part, value in zip((tree.feature, tree.threshold, tree.lower, tree.upper, tree.vote), (-1, 0.0, -1, -1, 0.0)):
            part.append(value)
        if line.startswith("Predict:"):
            tree.vote[node] = float(line.split(":")[1])
        else:
            asked = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
            tree.feature[node], tree.threshold[node] = int(asked[1]), float(asked[2])
            tree.lower[node] = grow()
            next(lines)
            tree.upper[node] = grow()
        return node

    grow()
    return tree


@dataclass(frozen=True)
class Model:
    """The trees of the forest and the dictionary it was trained with. Without trees every candidate counts as a secret."""

    trees: tuple[Tree, ...]
    words: frozenset[str]

    def probability(self, text: str, start: int, end: int) -> float:
        """The share of trees that vote for a secret."""
        values = features(text, start, end, self.words)
        return sum(tree(values) for tree in self.trees) / len(self.trees) if self.trees else 1.0

    def find(self, text: str | None) -> list[tuple[int, int, float]]:
        return [(i, j, self.probability(text, i, j)) for i, j in candidates(text)]


def train(findings: DataFrame, words: frozenset[str]) -> Model:
    """Train the forest on labelled findings (text, start, end, label). Without findings of both labels it has no tree."""
    rows = findings.select("text", "start", "end", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t, i, j, words) for t, i, j in zip(*(batch.column(k).to_pylist() for k in range(3)))]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.float64())), batch.column(3).cast(pa.float64())], names=["values", "label"])

    data = materialize(rows.mapInArrow(run, "values array<double>, label double"), "findings")
    if data.select("label").distinct().count() < 2:
        return Model((), words)
    data = data.repartition(4, "values").sortWithinPartitions("label", "values").select(array_to_vector("values").alias("features"), "label")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7).fit(data)
    return Model(tuple(_tree(tree.toDebugString) for tree in forest.trees), words)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", findings: DataFrame | None = None) -> Model:
    """The dictionary over all documents, and a forest trained on ``findings`` or on findings made from the documents."""
    return train(labelled_findings(docs, key, text) if findings is None else findings, dictionary(docs, text))


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, end, length, sha256, probability, is_secret) of every candidate in every text, places in code points from 0.

    Whole texts are searched. The value itself is not given, only its digest. Null and empty texts have no candidate; null and repeated keys are scanned
    like others; an empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, body in enumerate(batch.column(1).to_pylist()):
                for i, j, p in model.find(body):
                    out.append((k, i, j, hashlib.sha256(body[i:j].encode("utf-8", "surrogatepass")).hexdigest(), p))
            if out:
                at, *columns = zip(*out)
                kinds = (pa.int32(), pa.int32(), pa.string(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=["k", "start", "end", "sha256", "probability"]
                )

    found = rows.mapInArrow(run, f"k {rows.schema['k'].dataType.simpleString()}, start int, end int, sha256 string, probability double")
    return found.select(
        F.col("k").alias(key), "start", "end", (F.col("end") - F.col("start")).alias("length"), "sha256", "probability", (F.col("probability") >= ENOUGH).alias("is_secret")
    )


def mask(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark; all other characters, columns and rows stay as they are."""

    def cleaned(body: str | None) -> str | None:
        at, parts = 0, []
        for i, j, p in model.find(body):
            if p >= ENOUGH:
                parts += [body[at:i], MASK]
                at = j
        return "".join([*parts, body[at:]]) if parts else body

    names = docs.columns
    masked = with_columns(docs, [text], [T.StructField(text, T.StringType())], lambda texts: [[cleaned(t) for t in texts]])
    return masked.select(*[F.col(f"`{c}`") for c in names])
