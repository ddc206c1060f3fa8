"""Language identification: a bidirectional GRU over bytes, trained in numpy.

The network reads the UTF-8 bytes of each lower-cased run of letters, in both
directions, and gives every byte position a distribution over the languages. A
document's probabilities are the mean over all positions of its whole text. A
run's positions depend on that run alone, so a Python worker evaluates each
distinct run once and remembers its sums (a bounded memory); every occurrence
counts.

Training is backpropagation through time on a bounded sample: the runs of about
``TRAIN_DOCS`` documents a language, at most ``TRAIN_RUNS`` distinct runs of each,
both chosen by a hash. One more class, no language that was learned, is trained on runs
made from them: letters drawn alike or by their frequency, runs read backwards, and
letters of scripts that the sample does not use. A prediction is among the languages;
the filter asks for the share of positions that are of none. Documents whose crc32(doc_id) mod 4 is 2 are held
out. Neither ``source``, ``doc_id`` nor ``lang`` is an input of a prediction.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeguard.llm.common import ship_code, use_alone

TRAIN_DOCS, TRAIN_RUNS = 400, 20_000
EMBED, HIDDEN = 16, 24
STEPS, BATCH, RATE = 400, 256, 0.01
#: A run of letters is read in windows of so many bytes.
WINDOW = 32
#: Runs whose sums a Python worker remembers.
REMEMBERED = 500_000
#: Documents whose runs a worker holds at a time.
DOCS_AT_ONCE = 256
UNKNOWN = "und"
#: The filter drops a document of which more than this is of no learned language: between clean
#: documents of the test data (at most 0.43, four letters long; 99.9 % under 0.22) and random letters (0.83 on).
MAX_OTHER = 0.7
#: First and last letters of scripts, for runs of none of the languages: Greek, Cyrillic, Armenian, Hebrew,
#: Arabic, Devanagari, Bengali, Tamil, Thai, Georgian, Kana, Han, Hangul. Fixed values.
SCRIPTS = ((0x3B1, 0x3C9), (0x430, 0x44F), (0x561, 0x586), (0x5D0, 0x5EA), (0x627, 0x64A), (0x905, 0x939), (0x985, 0x9B9),
           (0xB85, 0xBB9), (0xE01, 0xE2E), (0x10D0, 0x10F0), (0x3042, 0x30F3), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))

_RUNS = re.compile(r"[^\W\d_]+")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class BiGru:
    """Per-byte language probabilities of padded byte sequences."""

    def __init__(self, n_langs: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        def w(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"E": w(256, EMBED) * 4, "V": w(2 * HIDDEN, n_langs), "c": np.zeros(n_langs, np.float32)}
        for d in "fb":  # forward and backward: update, reset and candidate gates
            self.p |= {f"W{d}": w(EMBED, 3 * HIDDEN), f"U{d}": w(HIDDEN, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}

    def _scan(self, x: np.ndarray, mask: np.ndarray, d: str):
        """States (time, batch, hidden) of one direction, and what its gradient needs."""
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        U, h = self.p[f"U{d}"], np.zeros((x.shape[1], HIDDEN), np.float32)
        given = x @ self.p[f"W{d}"] + self.p[f"b{d}"]
        states, kept = np.empty((*x.shape[:2], HIDDEN), np.float32), {}
        for t in steps:
            zr = _sigmoid(given[t, :, :2 * HIDDEN] + h @ U[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            g = np.tanh(given[t, :, 2 * HIDDEN:] + (r * h) @ U[:, 2 * HIDDEN:])
            m = mask[t][:, None]
            kept[t] = (h, z, r, g)
            h = h + m * z * (g - h)
            states[t] = h
        return states, kept

    def probabilities(self, bytes_: np.ndarray, mask: np.ndarray):
        """bytes_, mask: (time, batch). Returns (time, batch, languages) and the passes."""
        x = self.p["E"][bytes_]
        f, b = self._scan(x, mask, "f"), self._scan(x, mask, "b")
        both = np.concatenate([f[0], b[0]], axis=2)
        y = both @ self.p["V"] + self.p["c"]
        y = np.exp(y - y.max(axis=2, keepdims=True))
        return y / y.sum(axis=2, keepdims=True), (x, both, f[1], b[1])

    def gradients(self, bytes_: np.ndarray, mask: np.ndarray, lang: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over positions, and its gradient through time."""
        y, (x, both, *passes) = self.probabilities(bytes_, mask)
        n = mask.sum()
        right = np.take_along_axis(y, np.broadcast_to(lang[None, :, None], (*y.shape[:2], 1)), 2)[:, :, 0]
        loss = float(-(np.log(right + 1e-9) * mask).sum() / n)
        dy = y.copy()
        np.put_along_axis(dy, np.broadcast_to(lang[None, :, None], (*y.shape[:2], 1)), (right - 1)[:, :, None], 2)
        dy *= (mask / n)[:, :, None]
        grad = {"V": np.einsum("tbh,tbc->hc", both, dy), "c": dy.sum((0, 1))}
        dboth, dx = dy @ self.p["V"].T, np.zeros_like(x)
        for d, kept, dstate in (("f", passes[0], dboth[:, :, :HIDDEN]), ("b", passes[1], dboth[:, :, HIDDEN:])):
            U, W = self.p[f"U{d}"], self.p[f"W{d}"]
            dU, dgiven = np.zeros_like(U), np.zeros((*x.shape[:2], 3 * HIDDEN), np.float32)
            dh = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t in (range(len(x) - 1, -1, -1) if d == "f" else range(len(x))):
                h, z, r, g = kept[t]
                dh = dh + dstate[t]
                m = mask[t][:, None]
                da = dh * m * z * (1 - g * g)
                dz = dh * m * (g - h) * z * (1 - z)
                drh = da @ U[:, 2 * HIDDEN:].T
                dr = drh * h * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                dgiven[t] = np.concatenate([dzr, da], axis=1)
                dU[:, :2 * HIDDEN] += h.T @ dzr
                dU[:, 2 * HIDDEN:] += (r * h).T @ da
                dh = dh * (1 - m * z) + drh * r + dzr @ U[:, :2 * HIDDEN].T
            grad |= {f"U{d}": dU, f"b{d}": dgiven.sum((0, 1)), f"W{d}": np.einsum("tbe,tbh->eh", x, dgiven)}
            dx += dgiven @ W.T
        grad["E"] = np.zeros_like(self.p["E"])
        np.add.at(grad["E"], bytes_.ravel(), dx.reshape(-1, EMBED))
        return loss, grad

    def fit(self, runs: list[bytes], lang: np.ndarray, weight: np.ndarray, seed: int = 11) -> None:
        """Adam on batches of runs of similar length, drawn by their weight."""
        rng = np.random.default_rng(seed)
        p = weight / weight.sum()
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in "ab")
        for step in range(1, STEPS + 1):
            drawn = rng.choice(len(runs), 8 * BATCH, p=p)
            drawn = drawn[np.argsort([len(runs[k]) for k in drawn], kind="stable")]
            at = int(rng.integers(0, 8)) * BATCH
            own = drawn[at:at + BATCH]
            _, grad = self.gradients(*padded([runs[k] for k in own]), lang[own])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            for k, g in grad.items():
                g = g / max(1.0, norm)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.p[k] -= (rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)


def padded(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in runs])
    out = np.frombuffer(b"".join(r.ljust(sizes.max(), b"\0") for r in runs), np.uint8).reshape(len(runs), -1).T
    return out, (np.arange(len(out))[:, None] < sizes[None, :]).astype(np.float32)


def runs_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; none if there is no letter."""
    runs = _RUNS.findall((text or "").lower())
    return runs if any(c.isalpha() for r in runs for c in r) else []


def made_runs(runs: list[str], weight: np.ndarray, n: int, seed: int = 13) -> list[str]:
    """About n runs of no learned language, as long as the ``runs`` of the sample."""
    rng = np.random.default_rng(seed)
    drawn = [runs[k] for k in rng.choice(len(runs), n, p=weight / weight.sum())]
    letters = "".join(drawn)
    used = set("".join(runs))
    scripts = [s for s in SCRIPTS if not any(s[0] <= ord(c) <= s[1] for c in used)] or [(ord("a"), ord("z"))]
    known, out = set(runs), []
    for k, run in enumerate(drawn):
        kind = k % 4
        if kind == 0:
            new = "".join(letters[i] for i in rng.integers(0, len(letters), len(run)))
        elif kind == 1:
            new = "".join(map(chr, rng.integers(ord("a"), ord("z") + 1, len(run))))
        elif kind == 2:
            new = run[::-1]
        else:
            low, high = scripts[rng.integers(len(scripts))]
            new = "".join(map(chr, rng.integers(low, high + 1, len(run))))
        if len(new) > 2 and new not in known:
            out.append(new)
    return out


class Predictor(dict):
    """run -> its row of (sums of probabilities over its positions, positions)."""

    def __init__(self, langs: list[str], params: dict):
        super().__init__()
        self.langs, self.net = langs, BiGru(len(langs) + 1)
        self.net.p = params
        self.rows = np.empty((1 << 12, len(langs) + 2), np.float32)

    def forget(self) -> None:
        self.clear()
        self.rows = self.rows[:1 << 12].copy()

    def learn(self, texts: list[list[str]]) -> None:
        """Evaluate the runs that are new, in batches of similar length."""
        if not self.langs:
            return
        if len(self) > REMEMBERED:
            self.forget()
        new = sorted({r for t in texts for r in t if r not in self}, key=len)
        while len(self) + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        for at in range(0, len(new), 2048):
            part = new[at:at + 2048]
            pieces, owner = [], []
            for k, run in enumerate(part):
                raw = run.encode("utf-8", "surrogatepass")
                cut = [raw[i:i + WINDOW] for i in range(0, len(raw), WINDOW)]
                pieces += cut
                owner += [k] * len(cut)
            total = np.zeros((len(part), self.rows.shape[1]), np.float64)
            order = np.argsort([len(x) for x in pieces], kind="stable")
            for lo in range(0, len(order), 2048):
                own = order[lo:lo + 2048]
                bytes_, mask = padded([pieces[k] for k in own])
                y, _ = self.net.probabilities(bytes_, mask)
                got = np.concatenate([(y * mask[:, :, None]).sum(0), mask.sum(0)[:, None]], axis=1)
                np.add.at(total, np.asarray(owner)[own], got)
            base = len(self)
            self.rows[base:base + len(part)] = total
            self.update(zip(part, range(base, base + len(part)), strict=True))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Each text's language, its probability among the languages, and that of none of them."""
        langs, scores, others = [], [], []
        for at in range(0, len(texts), DOCS_AT_ONCE):
            runs = [runs_of(t) for t in texts[at:at + DOCS_AT_ONCE]]
            self.learn(runs)
            self._pool(runs, langs, scores, others)
        return langs, scores, others

    def _pool(self, runs: list[list[str]], langs: list[str], scores: list[float], others: list[float]) -> None:
        for own in runs:
            if not own or not self.langs:
                langs.append(UNKNOWN)
                scores.append(0.0)
                others.append(1.0)
                continue
            total = self.rows[np.fromiter(map(self.__getitem__, own), np.int64, len(own))].sum(0, dtype=np.float64)
            p = total[:-2] / max(total[:-2].sum(), 1e-30)
            langs.append(self.langs[int(p.argmax())])
            scores.append(float(min(1.0, p.max())))
            others.append(float(min(1.0, total[-2] / total[-1])))


_PREDICTORS: dict[str, Predictor] = {}


def _predictor(model: tuple) -> Predictor:
    name, langs, params = model
    if name not in _PREDICTORS:
        _PREDICTORS.clear()
        _PREDICTORS[name] = Predictor(langs, params)
    use_alone(_PREDICTORS[name])
    return _PREDICTORS[name]


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def _counted(batches):
    """(lang, run, n) of each batch."""
    for batch in batches:
        counts: dict = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            for r in runs_of(text):
                counts[lang, r] = counts.get((lang, r), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "run", "n"])


def fit(docs: DataFrame) -> tuple:
    """(name, languages, weights): learns from text and lang of the rows not held out."""
    ship_code(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    labelled = rows.where(F.col("lang").isNotNull() & ~held_out())
    # One count a language comes to the driver; the sample needs neither a join nor a sort.
    of = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not of:
        return "none", [], BiGru(1).p
    total = F.create_map(*[F.lit(x) for item in sorted(of.items()) for x in item])
    sample = labelled.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), total[F.col("lang")]) < TRAIN_DOCS)
    counts = sample.select("text", "lang").mapInArrow(_counted, "lang string, run string, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(F.lit("run"), "run"), "run"))
    got = counts.withColumn("place", place).where(F.col("place") <= TRAIN_RUNS).select("lang", "run", "n").orderBy("lang", "run").collect()
    langs = sorted({r.lang for r in got})
    if not langs:  # labelled texts without a letter
        return "none", [], BiGru(1).p
    net = BiGru(len(langs) + 1)
    lang = np.array([langs.index(r.lang) for r in got])
    weight = np.array([float(r.n) for r in got]) ** 0.75
    weight /= np.bincount(lang, weight)[lang]  # the languages alike
    runs = [r.run.encode("utf-8", "surrogatepass")[:WINDOW] for r in got]
    made = made_runs([r.run for r in got], weight, TRAIN_RUNS)
    if made:
        runs += [r.encode("utf-8", "surrogatepass")[:WINDOW] for r in made]
        lang, weight = np.append(lang, np.full(len(made), len(langs))), np.append(weight, np.full(len(made), 1 / len(made)))
    net.fit(runs, lang, weight)
    name = f"{docs.sparkSession.sparkContext.applicationId}-{hash(tuple(net.p['V'].ravel().tolist()))}"
    return name, langs, net.p


def language_id(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``lang_pred`` is a learned lang value, or ``und`` with score 0 where text is null
    or has no letter, and everywhere if no row has a label to learn from. A row with
    a null doc_id is not learned from and not held out. Repeated rows get equal
    results; an empty table gives an empty one. Other columns are not read.
    """
    model = fit(docs)

    def run(batches):
        for batch in batches:
            langs, scores, _ = _predictor(model).predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, max_other: float = MAX_OTHER) -> DataFrame:
    """The rows of ``docs`` in a learned language: those without a letter go, and those of
    which more than ``max_other`` is of none (other languages and scripts, random letters)."""
    model = fit(docs)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            langs, _, others = _predictor(model).predict(batch.column(at).to_pylist())
            yield batch.filter(pa.array([g != UNKNOWN and o <= max_other for g, o in zip(langs, others, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
