"""Regions of the personal-data model take in every form that it is trained to find."""

import random

from quarrylight.llm import pii


def test_generated_entities_lie_in_regions():
    rng, forms = random.Random(77), 0
    for _ in range(1500):
        text, marks = "", []
        for part, label in pii._sentence(rng):
            text += " " if text else ""
            if label:
                marks.append((len(text), len(text) + len(part)))
            text += part
        base = pii.base_spans(text)
        opened = pii.regions(text, base)
        for s, e in marks:
            if not any(a < e and s < b for _, a, b in base):  # base spans stay and bound regions
                forms += 1
                assert any(a <= s and e <= b for a, b in opened), text
    assert forms > 500


def test_addresses_written_out_in_any_case():
    model = pii.trained()
    for address in ("jane.doe at example.com", "jane_doe At mail Dot org", "bob at mail (dot) org", "jane [At] mail [Dot] org"):
        text = f"please write to {address} today"
        assert any(kind == 0 and text[s:e] == address for kind, s, e in pii.all_spans(text, model)[1]), address
    assert not pii.regions("they met at noon. Then at home they ate.", [])


NAMES = "john mary peter anna james susan robert linda michael sarah david emma thomas julia paul laura mark nina carlos elena pierre sophie hans greta".split()
FAMILIES = "smith jones miller brown wilson taylor garcia lopez dupont schmidt keller novak rossi evans clark".split()
HOSTS = "example acme bigcorp northwind contoso gmail hotmail bluebird harbour sunrise techlab greenfield".split()
ENDS = "com org net de fr es io".split()
AROUND = ("please write to {} today", "my mail is {} thanks", "you can reach her under {} any time", "contact {} for tickets", "send the form to {} before noon", "mail {} with questions", "he signed as {} on the list", "ask {} about it")
FORMS = (
    lambda f, l, h, t, n: f"{f} at {h}.{t}",
    lambda f, l, h, t, n: f"{f}.{l} at {h}.{t}",
    lambda f, l, h, t, n: f"{f}_{l} at {h}.{t}",
    lambda f, l, h, t, n: f"{f} at {h} dot {t}",
    lambda f, l, h, t, n: f"{f}.{l} (at) {h} (dot) {t}",
    lambda f, l, h, t, n: f"{f}[at]{h}[dot]{t}",
    lambda f, l, h, t, n: f"{f}{n} @ {h} . {t}",
    lambda f, l, h, t, n: f"{f.capitalize()} At {h}.{t}",
)
PLACES = """look at {} for more|the video is available at {} now|she works at {} since May|buy the tickets at {} please|we found the article at www.{}|a manager at {} told us|more details at {}
our friends at {} helped|the concert at {} was loud|read it at {} later|the prices at {} rose|sold at {} only|an engineer at {} said so|this shop at {} closes|stay at {} hotels""".replace("\n", "|").split("|")


def test_each_form_is_found_with_names_that_training_never_saw():
    """Ordinary names and hosts; the generator's are made of syllables."""
    model, rng = pii.trained(), random.Random(99)
    for k, form in enumerate(FORMS):
        hit = 0
        for _ in range(200):
            address = form(rng.choice(NAMES), rng.choice(FAMILIES), rng.choice(HOSTS), rng.choice(ENDS), rng.randint(1, 99))
            text = rng.choice(AROUND).format(address)
            hit += any(kind == 0 and text[s:e] == address for kind, s, e in pii.all_spans(text, model)[1])
        assert hit >= 180, (k, hit)
    wrong = sum(bool(pii.all_spans(rng.choice(PLACES).format(f"{rng.choice(HOSTS)}.{rng.choice(ENDS)}"), model)[1]) for _ in range(400))
    assert wrong <= 20, wrong


def test_the_best_segmentation_is_the_best_of_all():
    model, rng = pii.trained(), random.Random(3)
    for _ in range(60):
        text = " ".join(p for p, _ in pii._sentence(rng))[:48]
        lattice = pii.Lattice(text, 0, len(text))
        scores, ends = model._by_end(lattice)

        def all_of(j, later, label):
            """Best score of a segmentation of the first j tokens, the next segment having a label."""
            if j == 0:
                return later + model.transitions[0, label] if label is not None else later
            found = []
            for k in ends[j]:
                i, _, y, _ = lattice.segments[k]
                found.append(all_of(i, later + scores[k] + (0 if label is None else model.transitions[y, label]), y))
            return max(found)

        if len(lattice.tokens) > 11:
            continue
        chosen, at, total, last = model.best(lattice), 0, 0.0, 0
        places = {i: (y + 1, j) for y, i, j in chosen}
        by_segment = {(i, j, y): scores[k] for k, (i, j, y, _) in enumerate(lattice.segments)}
        while at < len(lattice.tokens):
            y, j = places.get(at, (0, at + 1))
            total += by_segment[at, j, y] + model.transitions[last, y]
            at, last = j, y
        assert abs(total - all_of(len(lattice.tokens), 0.0, None)) < 1e-9
