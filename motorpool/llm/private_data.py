"""Personal data in texts: fixed patterns, and a linear-chain conditional random field for the rest.

The field labels the words of each sentence as outside, or as beginning or continuing a name, an
address or an account number. Its features are word shapes (which kinds of characters a word begins
and ends with, holds, and how many) of a word and its neighbours, and a short list of cue words. It
is trained on the small table of labelled sentences below by gradient steps on the exact conditional
likelihood, and decoded by Viterbi for all sentences of a block of texts at once, in numpy.

Results in special cases: a null or empty text has no spans; a null doc_id stays null, and repeated
rows are taken one by one. Spans of the field that touch one of a fixed pattern aren't listed again.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa

from .words import ASCII_LOWER, joined, prefix_sums, slice_hashes, text_list, word_spans

#: Fixed patterns by kind, in the order of the listing; failing matches are dropped, not retried.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_RUN = re.compile(r"(?<![A-Za-z0-9._%+-])" + EMAIL.pattern)
#: A run of digits that gives no match from its start gives none from within, so only starts are tried.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_BLOCK_BYTES = 1_000_000


def _luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = ord(digit) - 48
        if place % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _digits(found):
    return [c for c in found if "0" <= c <= "9"]


def _emails(text):
    """Leftmost non-overlapping matches of EMAIL in linear time: a run of its letters is tried from its
    start, or from where the last match in it ended, and never again from within."""
    end = 0
    while found := EMAIL.match(text, end) or EMAIL_RUN.search(text, end):
        yield found
        end = found.end()


def base_spans(text):
    """(kind, start, end) by kind as listed, then start."""
    out = []
    if "@" in text:
        out += [("email", m.start(), m.end()) for m in _emails(text)]
    if "." in text:
        out += [
            ("ip", m.start(), m.end()) for m in IP.finditer(text)
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _digits(m[0])) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


LABELS = ("O", "B-name", "I-name", "B-address", "I-address", "B-account", "I-account")
KINDS = ("name", "address", "account")

#: Words that stand before or in personal data.
CUES = (
    "name named mr mrs ms dr prof dear signed contact regards called born herr frau monsieur madame "
    "senor senora don dona street st road rd avenue ave lane drive strasse platz rue calle plaza address "
    "adresse direccion live lives box account iban passport ssn license licence id number no kunde konto "
    "customer card at by and my is am the").split()

#: The labelled table: {name ...}, [address ...], <account ...>.
SENTENCES = """
My name is {Anna Berg} and I live at [12 Hill Street] in town.
Please contact {John A. Smith} for the rest.
Dear Mr {Brown}, your order is on its way.
Dear Mrs. {Lucy Green}, we thank you for your letter.
Signed {Peter Falk}
Regards, {Maria Lopez}
Dr. {Emil Weiss} lives at [5 Old Mill Road] near the river.
Her address is [221 Baker Street] and she is at home.
Ms {Jane Doe} of [77 West Avenue] wrote to us.
Herr {Karl Lang} und Frau {Eva Stein} wohnen hier.
Madame {Claire Petit} habite ici.
Senor {Juan Perez} vive en la casa.
The account number <4402-11-9837> is closed.
Her passport no <X1234567> was lost.
Customer id <AB-99812> has called again.
SSN <123-45-6789> must not be shown.
IBAN <DE44500105175407324931> belongs to the firm.
My account is <00129-4431> at the bank.
License number <D-8812-QX> expired in May.
He was named {Oscar Lund} after his uncle.
Born {Nils Holm} in 1950.
The house stands in a street without a name.
Anthe erthing of the sh and onre.
Thst reing. Hand oning the there and onea.
Anat Ber the onting in Erth.
It was 1999 and 25 people came to the place on the 3rd of May.
Number 7 is the best of the 12 we saw.
The road is long and the lane is narrow.
He is at the lake and my dog is in the garden.
Contact the office at any time.
Dear reader, this is the end of the story.
The drive took 45 minutes and 20 seconds at 90 km.
Version 2.0.1 was released with 1500 changes.
Name the three things that matter.
Thonea Thst An The and Ren.
A card is at the door and no one is there.
ON THE OTHER HAND ALL IS WELL
En la calle hay 3 casas y 4 coches.
Die Strasse ist lang und der Platz ist leer.
Copyright 2024 the authors, all rights reserved.
See page 12 and chapter 4 of the book.
In. On reads on the hand of it.
Of. It reats onre and ther.
La. Un casa de la que el.
As. To. Then and onder of it.
The. A thing of the re in.
Her. An erth. The on. Inge.
Inge onre hand.
Sondre.
Thea. Ronde.
That.*** The.*** Nting*** and of it.
Onre%%% is%%% En%%% the thing.
En. De. Die hand ist es.
By. Le. Au monde et en.
On by the At. Hand is. Am ende.
My. Re. Onder is as onre by the The.
At. At the end is by and by.
By the Thing of that. Is. My and.
Id. Es la no. Un dia.
Onou Onou Onou Onou Onou Onou Onou Onou
Of Of Of Of Of Of Of Of Of ble
Ciona. De, De, De, De, De, De esdo
Bare. Retion Retion Retion Retion ingan
Uede Uede Uede Uede las las las
THE! HAND! ON! THE! THING! IS! ON!
"""

_SHAPES = 64
_N_CUES = len(CUES) + 1
#: Feature blocks: shape here, before, after; cue here, before, two before, after; ends of the sentence.
_WIDTHS = (_SHAPES, _SHAPES + 1, _SHAPES + 1, _N_CUES, _N_CUES, _N_CUES, _N_CUES, 4)
_STARTS = np.cumsum((0, *_WIDTHS))

_CLASS = np.zeros(256, dtype=np.uint8)  # 0 punctuation, 1 lower or outside ASCII, 2 upper, 3 digit
_CLASS[128:] = 1
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3


def _cue_table():
    data, at = joined([c.encode() for c in CUES])
    hashes = slice_hashes(prefix_sums(data), at[:-1], at[1:] - 1)
    order = np.argsort(hashes)
    return hashes[order], order + 1


class _Words:
    """The words of texts laid end to end: spans, text and sentence of each, feature columns."""

    def __init__(self, texts):
        self.data, self.at = joined(texts)
        self.start, self.end = word_spans(self.data)
        n = len(self.start)
        kinds = _CLASS[self.data]
        counts = [np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int32)]) for k in (0, 2, 3)]
        other, upper, digit = (c[self.end] - c[self.start] for c in counts)
        size = self.end - self.start
        first, last = kinds[self.start] if n else kinds[:0], self.data[self.end - 1] if n else self.data[:0]
        body = np.select([digit == 0, digit + other >= size, digit > 0], [0, 1, 2])
        caps = np.select([upper == 0, upper == 1, upper + other == size], [0, 1, 2], 3)
        shape = (body * 4 + caps) * 4 + first
        self.shape = np.where(digit > 0, shape - shape % 4 + np.minimum(3, digit // 3), shape).astype(np.int64) % _SHAPES
        self.row = np.searchsorted(self.at, self.start, side="right") - 1
        # Cues: the word in lower case without punctuation at its ends.
        head = self.start + (first == 0)
        tail = np.maximum(self.end - (_CLASS[last] == 0), head)
        lower = np.frombuffer(self.data.tobytes().translate(ASCII_LOWER), dtype=np.uint8)
        hashes = slice_hashes(prefix_sums(lower), head, tail)
        known, number = _cue_table()
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        self.cue = np.where(known[place] == hashes, number[place], 0)
        # A sentence ends at the end of a line or of a text, and after a word with a full stop.
        lines = np.concatenate([[0], np.cumsum(self.data == 10, dtype=np.int64)])
        stop = np.isin(last, np.frombuffer(b".!?", np.uint8)) & (size > 3)
        cut = np.ones(n, dtype=bool)
        if n:
            cut[1:] = (lines[self.start[1:]] != lines[self.start[:-1]]) | stop[:-1]
        self.first = np.flatnonzero(cut)
        self.sentence_end = np.append(self.first[1:], n) if n else self.first

    def features(self):
        """Columns of feature numbers, a row for each word."""
        n = len(self.start)
        inside, final = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        inside[self.first] = False
        final[self.sentence_end - 1] = False

        def shifted(values, by, none):
            out = np.full(n, none)
            if by < 0:
                out[-by:] = values[:by]
                return np.where(inside, out, none)
            out[:-by] = values[by:]
            return np.where(final, out, none)

        before = shifted(self.cue, -1, 0)
        parts = (
            self.shape, shifted(self.shape, -1, _SHAPES), shifted(self.shape, 1, _SHAPES), self.cue, before,
            shifted(before, -1, 0), shifted(self.cue, 1, 0), 2 * inside + final)
        return np.stack([p + s for p, s in zip(parts, _STARTS, strict=False)], axis=1) if n else np.zeros((0, len(parts)), np.int64)


def _parsed(line):
    """A line of SENTENCES as (text, label of each word)."""
    words, labels, kind, begun = [], [], 0, False
    for word in line.split():
        opened = "{[<".find(word[0]) + 1
        if opened:
            kind, begun, word = opened, True, word[1:]
        closed = re.search(r"[}\]>]", word)
        words.append(re.sub(r"[}\]>]", "", word))
        labels.append(0 if not kind else 2 * kind - 1 + (not begun))
        begun = False
        if closed:
            kind = 0
    return " ".join(words), labels


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _gradient(single, pair, labels, features, grad_single, grad_pair):
    """Adds the gradient of one sentence's conditional log-likelihood."""
    emit = single[features].sum(axis=1)
    n, k = emit.shape
    ahead, back = np.zeros((n, k)), np.zeros((n, k))
    ahead[0] = emit[0] + pair[k]
    for t in range(1, n):
        ahead[t] = emit[t] + _log_sum(ahead[t - 1][:, None] + pair[:k], 0)
    for t in range(n - 2, -1, -1):
        back[t] = _log_sum(pair[:k] + (emit[t + 1] + back[t + 1])[None, :], 1)
    total = _log_sum(ahead[-1], 0)
    here = -np.exp(ahead + back - total)
    here[np.arange(n), labels] += 1
    np.add.at(grad_single, features.reshape(-1), np.repeat(here, features.shape[1], axis=0))
    grad_pair[k, labels[0]] += 1
    grad_pair[k] -= np.exp(ahead[0] + back[0] - total)
    for t in range(1, n):
        grad_pair[labels[t - 1], labels[t]] += 1
        grad_pair[:k] -= np.exp(ahead[t - 1][:, None] + pair[:k] + (emit[t] + back[t])[None, :] - total)


def trained(rounds=120, rate=0.2, shrink=0.01):
    """(weights of features, weights of neighbouring labels; the last row: of the first label).

    Adam steps on all sentences; a label that continues a kind can only follow that kind.
    """
    table = []
    for line in SENTENCES.strip().split("\n"):
        text, labels = _parsed(line)
        words = _Words([text.encode()])
        labels, features = np.array(labels), words.features()
        for a, b in zip(words.first, words.sentence_end, strict=True):
            table.append((labels[a:b], features[a:b]))
    k = len(LABELS)
    single, pair = np.zeros((_STARTS[-1], k)), np.zeros((k + 1, k))
    barred = np.zeros_like(pair, dtype=bool)
    for label in range(2, k, 2):
        barred[:, label] = True
        barred[[label - 1, label], label] = False
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (single, pair)]
    for step in range(1, rounds + 1):
        grads = [np.zeros_like(single), np.zeros_like(pair)]
        closed = np.where(barred, -30.0, pair)
        for labels, features in table:
            _gradient(single, closed, labels, features, *grads)
        for w, g, (m, v) in zip((single, pair), grads, moments, strict=True):
            g -= shrink * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return single.astype(np.float32), np.where(barred, -30.0, pair).astype(np.float32)


def decoded(words, model):
    """The best label of each word: Viterbi over all sentences side by side, longest first."""
    single, pair = model
    features, k = words.features(), len(LABELS)
    labels = np.zeros(len(features), dtype=np.int8)
    if not len(features):
        return labels
    # Only a sentence with a word that is more than plain lower-case can hold personal data beyond
    # its first word; plain ones are labelled by the same scores, all outside.
    emit = single[features[:, 0]]
    for column in range(1, features.shape[1]):
        emit += single[features[:, column]]
    size = words.sentence_end - words.first
    order = np.argsort(-size, kind="stable")
    first, size = words.first[order], size[order]
    best = emit[first] + pair[k]
    back = np.zeros((len(features), k), dtype=np.int8)
    for t in range(1, int(size[0])):
        alive = int(np.searchsorted(-size, -t, side="left"))  # sentences of more than t words
        at = first[:alive] + t
        scores = best[:alive, :, None] + pair[None, :k]
        back[at] = scores.argmax(axis=1)
        best[:alive] = scores.max(axis=1) + emit[at]
    now = best.argmax(axis=1)
    for t in range(int(size[0]) - 1, -1, -1):
        alive = int(np.searchsorted(-size, -t, side="left"))
        at = first[:alive] + t
        labels[at] = now[:alive]
        now[:alive] = back[at, now[:alive]]
    return labels


def field_spans(texts, model):
    """For each text (UTF-8) the spans (kind, start, end) of the field, in code points."""
    words = _Words(texts)
    labels = decoded(words, model)
    out = [[] for _ in texts]
    begins = np.flatnonzero(labels % 2 == 1)
    for i in begins.tolist():
        j = i + 1
        while j < len(labels) and labels[j] == labels[i] + 1:
            j += 1
        row = int(words.row[i])
        a, b = int(words.start[i] - words.at[row]), int(words.end[j - 1] - words.at[row])
        while b > a and _CLASS[texts[row][b - 1]] == 0:
            b -= 1
        while a < b and _CLASS[texts[row][a]] == 0:
            a += 1
        if a < b:
            start = len(texts[row][:a].decode("utf-8", "replace"))
            out[row].append((KINDS[(int(labels[i]) - 1) // 2], start, start + len(texts[row][a:b].decode("utf-8", "replace"))))
    return out


def _listing(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def private(docs):
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row of docs (doc_id, text)."""
    model = trained()
    kinds = ("email", "ip", "card", "phone")

    def blocks(batch):
        ids, texts, held = [], [], 0
        for i, text in zip(batch["doc_id"].to_pylist(), text_list(batch["text"]), strict=True):
            if held and held + len(text) > _BLOCK_BYTES:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(text)
            held += len(text)
        if ids:
            yield ids, texts

    def find(batches):
        for batch in batches:
            for ids, texts in blocks(batch):
                rows = []
                for text, more in zip(texts, field_spans(texts, model), strict=True):
                    base = base_spans(text.decode())
                    new = [s for s in more if not any(s[1] < b[2] and b[1] < s[2] for b in base)]
                    new.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
                    count = [sum(b[0] == kind for b in base) for kind in kinds]
                    rows.append((*count, hashlib.sha256(_listing(base).encode()).hexdigest(), _listing(base + new)))
                *counts, sha, spans = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha), pa.array(spans)],
                    names=["doc_id", *(f"n_{k}" for k in kinds), "base_sha256", "spans"])

    schema = "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in kinds) + ", base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(find, schema)
