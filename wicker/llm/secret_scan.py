"""Secret scans by a linear-chain conditional random field.

Rules find the plain cases.  Beside them a CRF tags every token of a text as the
beginning of a secret, inside one, or outside, from the token's shape, the words
around it and features of the whole text; Viterbi decoding picks the best tags.
The field is trained on windows of the corpus: the rules' own finds, and secrets in
other forms that are planted into its texts (other credential words, other ways to
tie a value to them, other kinds of values), beside decoys that look alike (the same
words before plain ones, dates, numbers, names).  Secrets' letters are hidden behind
their shape and credential words share a feature, so that the field generalises from
the context and the shape to forms that neither a rule nor a planted one spells out.

A token whose margin for "outside" is larger than any change of transitions could
make up for is outside in every best path.  The chain is cut at such tokens, which
changes no result, and only the short stretches between them are decoded.

Null and empty texts have no spans.  Repeated rows get equal results.  Very long
texts are scanned whole.  Spans count code points.  Other columns are kept by
``redact``, whatever their names.  An empty table gives no rows; without any text
with a word, the field adds nothing.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches, text_of

KINDS = ("assign", "access", "hex", "crf")
#: The rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[\w+/.-]+=*|[^\w\s+/.-]+")
#: Words that are told apart, those for credentials and others near
#: them; of all other words only the shape counts.
CREDENTIALS = frozenset("apikey auth authorization bearer credential credentials key passcode passphrase passwd password pass pin private pwd pw secret signing token".split())
CONTEXT = CREDENTIALS | frozenset("access account api aws basic client id is login session user was with".split())
#: What is planted for training.  Credential words, what ties a value
#: to them, and words and values that are no secrets.
KEYS = ("pwd", "Pwd", "pass", "passphrase", "password", "Password", "PASSWD", "secret", "token", "api key", "API key", "access key", "private key", "credential",
    "credentials", "session key", "bearer", "Bearer", "user pwd", "SECRET_KEY", "db_pass", "auth_token", "accessKey")
TIES = (" = {}", "={}", ": {}", ":{}", " {}", " is {}", " => {}", ' = "{}"', "='{}'", ': "{}"', " '{}'", " was {}", " set to {}", " `{}`", "[{}]", " [{}]", ": ({})",
    " <{}>", " / {}", "... {}", " ~ {} ~")
OTHERS = ("commit", "version", "order", "file", "id", "etag", "build", "size", "date", "model", "page", "user", "account", "number", "client", "session", "ticket", "die", "le", "el")
PLAIN = ("required", "expired", "invalid", "below", "none", "changed", "management", "reset", "policy", "holder", "length", "field", "optional", "encrypted", "stored",
    "rotation", "your_password_here", "the", "and", "of", "not", "two", "see")
#: Of every text in which a rule matches, lower case has one of these,
#: it has AKIA, or the rule is the one for hex.
WORDS = ("passw", "secret", "token", "api")
#: Texts with a find of the rules, and as many without, that the field is trained on,
#: and secrets and decoys planted into each.
TRAIN_TEXTS = 300
PLANTED, DECOYS = 3, 6
#: Training windows that come to the driver at most, by hash: 500 bytes each.
TRAIN_WINDOWS = 20_000
SEGMENT = 16
NEAR = 20_000  # characters around what is planted
FEATURES = 1 << 13
#: Features of a token, by column: at most six of its own, of three neighbours each,
#: two of the text.
GROUPS = (0, 6, 12, 18, 24, 26)
WIDTH = GROUPS[-1]
ROUNDS, RATE = 50, 0.35
SECRET_WEIGHT = 6.0  # of a training window with a secret
REMEMBERED = 1 << 20
B, I, O = 0, 1, 2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' finds, in order."""
    out = []
    low = text.lower()
    if any(k in low for k in WORDS) or not low.isascii():
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# --- features -----------------------------------------------------------------


def _slot(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little") % FEATURES


def _size(n: int) -> int:
    return n if n < 8 else 8 + int(math.log2(n / 8) * 2)


@functools.lru_cache(maxsize=1 << 16)
def _features(shape: str) -> dict[str, tuple[int, ...]]:
    """Slots of what a token of this shape says about itself and its neighbours."""
    parts = shape.split("\t")
    return {role: tuple(_slot(f"{role}|{x}") for x in parts) for role in ("own", "next", "last", "before")}


def shape_of(token: str) -> str:
    """The features of a token, tab-separated: a short word's letters; of others
    the classes of characters, the length and how mixed they are."""
    core = token.rstrip("=")
    tied = "" if core == token or not core else "\ttied"
    if core.isalpha():
        low = core.lower()
        case = "lower" if core == low else "upper" if core.isupper() else "title" if core.istitle() else "mixed"
        word = f"w={low}" if low in CONTEXT else "w=other"
        kin = "credential" if low in CREDENTIALS else "near" if low in CONTEXT else "plain"
        return f"letters {case}\tsize={_size(len(core))}\t{word}\t{kin}{tied}"
    named = [w for w in re.split(r"[_.-]", re.sub(r"(?<=[a-z])(?=[A-Z])", "_", core).lower()) if w in CONTEXT] if len(core) < 32 else []
    if named and not any(c.isdigit() for c in core):
        kin = "credential" if CREDENTIALS & set(named) else "near"
        return f"name\tsize={_size(len(core))}\tw={named[-1]}\t{kin}{tied}"
    if not any(c.isalnum() for c in token):
        return f"marks\tm={token[:3]}"
    runs = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "0", core)))
    flat = "".join(sorted(set(runs)))[:6]
    count = Counter(core)
    entropy = -sum(n / len(core) * math.log2(n / len(core)) for n in count.values())
    changes = len(re.findall(r"(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]", core))
    hexes = "hex" if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", core) else "not hex"
    return f"kind={flat}\tsize={_size(len(core))}\tentropy={round(entropy * 2)}\tchanges={_size(changes)}\t{hexes} {_size(len(core))}{tied}"


def text_features(tokens: list[str]) -> tuple[int, ...]:
    """Slots of what a whole text says about its tokens."""
    n = max(1, len(tokens))
    marks = sum(map(tokens.count, ("=", ":", "{", "}")))
    return _slot(f"text|marks={_size(100 * marks // n)}"), _slot(f"text|size={_size(n)}")


# --- the field ----------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """Scores: of features for each tag, and of a tag after a tag."""

    weight: np.ndarray  # (FEATURES, 3)
    move: np.ndarray  # (3, 3)

    @property
    def trained(self) -> bool:
        """Whether it prefers any tag; all scores of one that doesn't are equal."""
        return bool(self.weight.any() or self.move.any())

    def scores(self, shape: str) -> np.ndarray:
        """(4, 3): own, to the token before, to the next, to the one after it."""
        f = _features(shape)
        return np.stack([self.weight[list(f[role])].sum(0) for role in ("own", "next", "last", "before")])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def train(slots: np.ndarray, tags: np.ndarray, weight_of: np.ndarray) -> Field:
    """Maximum likelihood for segments: slots (segments, tokens, features; FEATURES
    for none), tags (segments, tokens); by forward-backward sums and Adagrad steps."""
    n, length, width = slots.shape
    weight, move = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    grad_w, grad_m = np.full_like(weight, 1e-3), np.full_like(move, 1e-3)
    gold = np.eye(3)[tags] * weight_of[:, None, None]
    gold_moves = np.einsum("sti,stj->ij", gold[:, :-1], np.eye(3)[tags[:, 1:]])
    # Few kinds of tokens stand in each role: their sums are worked out once a round.
    flat = slots.reshape(n * length, width)
    ends = GROUPS if width == WIDTH else (0, width)
    kinds = [np.unique(flat[:, a:b], axis=0, return_inverse=True) for a, b in zip(ends, ends[1:], strict=False)]
    kinds = [(rows, of.ravel()) for rows, of in kinds]
    for _ in range(ROUNDS):
        padded = np.concatenate([weight, np.zeros((1, 3))])
        emit = sum(padded[rows].sum(1)[of] for rows, of in kinds).reshape(n, length, 3)
        ahead, behind = np.empty_like(emit), np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0]
        for t in range(1, length):
            ahead[:, t] = emit[:, t] + _log_sum(ahead[:, t - 1, :, None] + move, 1)
        for t in range(length - 2, -1, -1):
            behind[:, t] = _log_sum(move + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        total = _log_sum(ahead[:, -1], 1)
        belief = np.exp(ahead + behind - total[:, None, None]) * weight_of[:, None, None]
        pair = np.exp(ahead[:, :-1, :, None] + move + (emit + behind)[:, 1:, None, :] - total[:, None, None, None])
        moves = (pair * weight_of[:, None, None, None]).sum((0, 1))
        error = ((gold - belief) / n).reshape(-1, 3)
        gw = -1e-5 * weight
        for rows, of in kinds:
            for y in range(3):
                gw[:, y] += np.bincount(rows.ravel(), np.bincount(of, error[:, y], len(rows)).repeat(rows.shape[1]), FEATURES + 1)[:FEATURES]
        gm = (gold_moves - moves) / n - 1e-4 * move
        grad_w += gw**2
        grad_m += gm**2
        weight += RATE * gw / np.sqrt(grad_w)
        move += RATE * gm / np.sqrt(grad_m)
    return Field(weight, move)


def viterbi(emit: np.ndarray, move: np.ndarray, before: int | None, after: int | None) -> list[int]:
    """Best tags of a stretch, given the tags on either side."""
    score = emit[0] + (move[before] if before is not None else 0)
    back = []
    for e in emit[1:]:
        both = score[:, None] + move
        back.append(both.argmax(0))
        score = both.max(0) + e
    if after is not None:
        score = score + move[:, after]
    tags = [int(score.argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


class Tagger:
    """A field with the scores of the tokens it has met."""

    def __init__(self, field: Field):
        self.field = field
        self.trained = field.trained
        self.most = 2 * float(field.move.max() - field.move.min())
        self._new()

    def _new(self) -> None:
        self.row: dict[str, int] = {"": 0}
        self.by_shape: dict[str, int] = {"": 0}
        self.table = np.zeros((1024, 4, 3))

    def _rows(self, tokens: list[str]) -> np.ndarray:
        row = self.row
        if len(row) > REMEMBERED:
            self._new()
            row = self.row
        try:
            return np.fromiter(map(row.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            pass
        for t in set(tokens):
            if t in row:
                continue
            shape = shape_of(t)
            at = self.by_shape.get(shape)
            if at is None:
                at = self.by_shape[shape] = len(self.by_shape)
                if at >= len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[at] = self.field.scores(shape)
            row[t] = at
        return np.fromiter(map(row.__getitem__, tokens), np.int64, len(tokens))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Code point spans that the field tags as secrets."""
        tokens = TOKEN.findall(text) if self.trained else []
        if not tokens:
            return []
        r = self._rows(tokens)
        table = self.table
        emit = table[r, 0] + self.field.weight[list(text_features(tokens))].sum(0)
        emit[:-1] += table[r[1:], 1]
        emit[1:] += table[r[:-1], 2]
        emit[2:] += table[r[:-2], 3]
        unsure = np.flatnonzero(emit[:, O] - np.maximum(emit[:, B], emit[:, I]) <= self.most)
        if not len(unsure):
            return []
        found = []
        for part in np.split(unsure, np.flatnonzero(np.diff(unsure) > 1) + 1):
            a, b = int(part[0]), int(part[-1]) + 1
            tags = viterbi(emit[a:b], self.field.move, O if a else None, O if b < len(tokens) else None)
            for i, tag in enumerate(tags, a):
                if tag == B or tag == I and (not found or found[-1][1] != i):
                    found.append([i, i + 1])
                elif tag == I:
                    found[-1][1] = i + 1
        if not found:
            return []
        at = [m.span() for m in TOKEN.finditer(text)]
        return [(at[i][0], at[j - 1][1]) for i, j in found]


def secret_value(rng: np.random.Generator) -> str:
    """A random secret of one of several kinds."""
    draw = lambda letters, low, high: "".join(rng.choice(list(letters), int(rng.integers(low, high + 1))))
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    kind = int(rng.integers(9))
    if kind == 0:
        return draw(upper + lower + digits + "+/", 18, 48) + "=" * int(rng.integers(3))
    if kind == 1:
        return draw(digits + "ABCDEF", 12, 48)
    if kind == 2:
        return draw(digits + "abcdef", 10, 23)
    if kind == 3:
        return draw(lower, 2, 3) + "_" + draw(upper + lower + digits, 14, 40)
    if kind == 4:  # a password with marks inside
        return draw(upper + lower, 3, 7) + draw("!@#$%&*", 1, 2) + draw(lower + digits, 2, 5) + draw(digits, 1, 3)
    if kind == 5:
        return ".".join(draw(upper + lower + digits + "_-", 8, 24) for _ in range(3))
    if kind == 6:
        return "-".join(draw(digits + "abcdef", n, n) for n in (8, 4, 4, 4, 12))
    if kind == 7:
        return draw(lower, 3, 8) + draw(digits, 2, 4) + draw(lower + digits, 2, 8)
    return draw(upper + lower + digits, 10, 40)


def _plain_value(rng: np.random.Generator, words: list[str]) -> str:
    """What may stand where a secret could, and is none."""
    n = lambda low, high: int(rng.integers(low, high))
    kinds = (
        lambda: str(rng.choice(words)), lambda: str(rng.choice(PLAIN)), lambda: str(n(0, 10 ** n(1, 17))), lambda: f"{n(1990, 2031)}-{n(1, 13):02}-{n(1, 29):02}",
        lambda: f"{n(0, 256)}.{n(0, 256)}.{n(0, 256)}.{n(0, 256)}",
        lambda: f"v{n(0, 20)}.{n(0, 20)}.{n(0, 99)}", lambda: f"{rng.choice(words)}.{n(0, 100)}@mail{n(0, 10)}.example.com",
        lambda: f"+{n(10, 99)} {n(100, 999)} {n(10**5, 10**7)}", lambda: f"IMG_{n(2000, 2031)}{n(10, 13)}{n(10, 29)}.jpg", lambda: f"{n(1, 500)}kg",
        lambda: f"{rng.choice(words)}_{rng.choice(words)}", lambda: f"{n(0, 24):02}:{n(0, 60):02}",
        lambda: str(rng.choice(words))[:2].upper() + str(rng.choice(words)), lambda: str(rng.choice(words)) + str(rng.choice(words)).title(),
        lambda: f"{rng.choice(words)}{n(0, 100)}", lambda: f"{rng.choice(words).upper()}_{rng.choice(words).upper()}",
    )
    return kinds[n(0, len(kinds))]()


def planted(text: str, rng: np.random.Generator, secret: bool, keys: tuple[str, ...] = KEYS, ties: tuple[str, ...] = TIES) -> tuple[str, int, int]:
    """``text`` with a secret, or with a decoy, put in between two words, and the
    span of its value."""
    words = [w for w in re.findall(r"[^\W\d_]+", text) if w.lower() not in CONTEXT] or list(PLAIN)
    tie = str(rng.choice(ties))
    if secret:
        key, value = str(rng.choice(keys)), secret_value(rng)
    else:
        kind = int(rng.integers(4))
        key, value = str(rng.choice(keys if kind < 2 else OTHERS)), _plain_value(rng, words)
        if kind == 3:
            key, tie = "", "{}"
        elif key in OTHERS and rng.random() < 0.2:
            value = "".join(rng.choice(list("0123456789abcdef"), int(rng.integers(7, 20))))
    before, after = (key + tie).split("{}")
    gaps = [m.end() for m in re.finditer(r"\s+", text)] or [0]
    at = int(rng.choice(gaps))
    lead = text[:at] + before
    return f"{lead}{value}{after} {text[at:]}", len(lead), len(lead) + len(value)


def value_spans(text: str) -> list[tuple[int, int]]:
    """What is secret in the rules' finds."""
    return [(ASSIGN.match(text, a).start(2) if kind == 0 else a, b) for a, kind, b in base_spans(text)]


def _windows(text: str, spans: list[tuple[int, int]], centres: list[int], whole: tuple[int, ...], slots: list, tags: list) -> None:
    """Windows around places of a text (or of a part of one whose features are
    ``whole``), with the features and tags of their tokens."""
    at = [m.span() for m in TOKEN.finditer(text)]
    tokens = [text[a:b] for a, b in at]
    tag = np.full(max(len(at), SEGMENT), O)
    starts = np.array([a for a, _ in at])
    for a, b in spans:
        i, j = max(0, int(np.searchsorted(starts, a, "right")) - 1), int(np.searchsorted(starts, b, "left"))
        tag[i] = B
        tag[i + 1 : j] = I
    shapes: dict[int, dict] = {}

    def pick(k: int, role: str) -> tuple[int, ...]:
        if not 0 <= k < len(tokens):
            return ()
        if k not in shapes:
            shapes[k] = _features(shape_of(tokens[k]))
        return shapes[k][role]

    for c in centres:
        i = max(0, int(np.searchsorted(starts, c, "right")) - 1)
        s = max(0, min(i - SEGMENT // 2, len(tokens) - SEGMENT))
        slots.append([(pick(k, "own"), pick(k + 1, "next"), pick(k - 1, "last"), pick(k - 2, "before"), whole) for k in range(s, s + SEGMENT)])
        tags.append(tag[s : s + SEGMENT])


def _segments(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Training windows of texts: around each of the rules' finds, two anywhere, and around
    what is planted."""
    slots, tags = [], []
    for text in texts:
        if not TOKEN.search(text):
            continue
        rng = np.random.default_rng(int(hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()[:15], 16))
        whole = text_features(TOKEN.findall(text))
        own = value_spans(text)
        _windows(text, own, [a for a, _ in own] + rng.integers(0, len(text), 2).tolist(), whole, slots, tags)
        for k in range(PLANTED + DECOYS):
            start = int(rng.integers(0, max(1, len(text) - NEAR)))  # a window needs no more around it
            new, a, b = planted(text[start : start + NEAR], rng, secret=k < PLANTED)
            _windows(new, value_spans(new) + [(a, b)] * (k < PLANTED), [a], whole, slots, tags)
    out = np.full((len(slots), SEGMENT, WIDTH), FEATURES, np.int64)
    for a, rows in enumerate(slots):
        for b, groups in enumerate(rows):
            for at, r in zip(GROUPS, groups, strict=False):
                out[a, b, at : at + len(r)] = r
    return out, np.array(tags).reshape(-1, SEGMENT)


def rule_matches(t: Column) -> Column:
    """Whether a rule matches in a text; the rules' expressions as Java reads them."""
    low = F.lower(t)
    named = low.contains(WORDS[0])
    for word in WORDS[1:]:
        named = named | low.contains(word)
    assign = ASSIGN.pattern.replace("[A-Za-z0-9+/_.=-]+", "[A-Za-z0-9+/_.=-]{6,}")
    return (t.contains("AKIA") & t.rlike(ACCESS.pattern)) | (named & t.rlike(f"(?i){assign}")) | t.rlike(HEX.pattern)


def fit(docs: DataFrame, text: str = "text", texts: int = TRAIN_TEXTS) -> Field:
    """A field trained on windows of at most ``texts`` texts in which a rule matches
    and as many others, chosen by hash; their windows (each find of a rule, two anywhere,
    ``PLANTED`` + ``DECOYS`` with something planted) come to the driver, ``TRAIN_WINDOWS`` at most, chosen
    by hash too.  Without any text, a field that adds nothing."""
    t = text_of(text)
    hit = rule_matches(t)
    # The hashes of both samples first, so that texts don't take part in the sort.
    chosen = docs.select(t.alias("text"), hit.alias("hit"), F.xxhash64(t).alias("h"))
    keys = cut(chosen.select("hit", "h").distinct())
    most = {side: keys.where(F.col("hit") == side).orderBy("h").limit(texts).agg(F.max("h")).first()[0] for side in (True, False)}
    least = -(1 << 63)
    inside = F.col("h") <= F.when(F.col("hit"), least if most[True] is None else most[True]).otherwise(least if most[False] is None else most[False])

    def windows(batch: pa.RecordBatch) -> pa.RecordBatch:
        slots, tags = _segments(batch.column(0).to_pylist())
        raw = [x.astype(np.int16).tobytes() for x in slots]
        return pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), pa.array([x.astype(np.int8).tobytes() for x in tags], pa.binary())], ["slots", "tags"])

    source = chosen.where(inside).select("text").distinct()
    source = source.repartition(docs.sparkSession.sparkContext.defaultParallelism)  # a few texts with much work each
    found = map_batches(source, windows, "slots binary, tags binary").orderBy(F.xxhash64("slots", "tags"), "slots", "tags")
    got = found.limit(TRAIN_WINDOWS).toArrow()
    if not got.num_rows:
        return Field(np.zeros((FEATURES, 3)), np.zeros((3, 3)))
    slots = np.stack([np.frombuffer(x, np.int16).reshape(SEGMENT, WIDTH) for x in got.column(0).to_pylist()]).astype(np.int64)
    tags = np.stack([np.frombuffer(x, np.int8) for x in got.column(1).to_pylist()]).astype(np.int64)
    return train(slots, tags, np.where((tags != O).any(1), SECRET_WEIGHT, 1.0))


_TAGGERS: dict[bytes, Tagger] = {}


def _tagger(shared) -> Tagger:
    weight, move, key = shared.value
    if key not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[key] = Tagger(Field(weight, move))
    return _TAGGERS[key]


def all_spans(text: str, tagger: Tagger) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The rules' spans; those and the parts of the field's that lie outside them."""
    base = base_spans(text)
    return base, sorted(base + [(a, 3, b) for span in tagger.spans(text) for a, b in outside(text, *span, base)])


def outside(text: str, start: int, end: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of a span in none of the spans of ``base``, without blanks at
    their ends."""
    parts, at = [], start
    for a, _, b in base:  # in order of their starts
        if b > at and a < end:
            parts.append((at, a))
            at = b
    parts.append((at, end))
    trimmed = ((a + len(t) - len(t.lstrip()), b - len(t) + len(t.rstrip())) for a, b in parts if a < b and (t := text[a:b]).strip())
    return list(trimmed)


def _share(docs: DataFrame, field: Field):
    key = hashlib.md5(field.weight.tobytes() + field.move.tobytes()).digest()
    return docs.sparkSession.sparkContext.broadcast((field.weight, field.move, key))


def scan_secrets(docs: DataFrame, field: Field | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans of every row."""
    shared = _share(docs, field or fit(docs, text))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for t in batch.column(1).to_pylist():
            base, spans = all_spans(t, _tagger(shared))
            n = Counter(k for _, k, _ in base)
            rows.append((n[0], n[1], n[2], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans)))
        types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return map_batches(source, run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long")


def redact(docs: DataFrame, field: Field | None = None, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; other columns,
    rows and null texts stay as they are."""
    shared = _share(docs, field or fit(docs, text))
    position = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t in batch.column(position).to_pylist():
            if t:
                _, spans = all_spans(t, _tagger(shared))
                parts, last = [], 0
                for a, _, b in spans:
                    if b > last:
                        parts += [t[last:a], mark] if a > last or not parts and a >= last else []
                        last = b
                t = "".join([*parts, t[last:]])
            out.append(t)
        columns = list(batch.columns)
        columns[position] = pa.array(out, pa.string())
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return map_batches(docs, run, docs.schema, column=text)
