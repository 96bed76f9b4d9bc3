"""The personal-data model on sentences written by hand, none of them made by the generator that trains it."""

import re

from quarrylight.llm import pii

#: Marked spans that the base patterns don't find, as «kind|text».
MARKED = """
Please send the form to «email|jane dot doe at example dot com» before Friday.
You can reach Bob under «email|bob.miller (at) firma.de» or come by.
Questions? «email|support[at]acme-tools[dot]org» answers within a day.
My address is «email|k_schmidt AT uni-bonn DOT de», thanks!
contact me: «email|pierre.dupont (at) laposte (dot) net»
Escríbame a «email|maria.lopez {at} correo {dot} es» cuando quiera.
He signed as «email|t.brown at mail dot example dot org» on the list.
Write to «email|anna_lind at gmail.com» for tickets.
her mail was «email|peggy99 @ hotmail . com» back then
Send logs to «email|ops-team [at] status dot io» please.
Kontakt: «email|info(at)baeckerei-huber.de»
You'll find me as «email|x.wang at cs dot stanford dot edu» most days.
Call me at «phone|(415) 555-2671» after six.
Our fax is «phone|415-555-2671».
Dial «phone|1-800-555-0199» toll free.
Tel. «phone|0221 4710815» (office hours)
Rufen Sie «phone|0049 30 1234567» an.
Appelez le «phone|01 42 68 53 00» pour réserver.
Llame al «phone|912 345 678» por la tarde.
phone: «phone|202.555.0143»
Text «phone|202 555 0143» with your name.
Or «phone|1 (650) 253-0000» from abroad.
The box answers on «ip|192[.]168[.]0[.]12» only.
Blocked «ip|10(.)0(.)0(.)254» yesterday.
The beacon went to «ip|203 . 0 . 113 . 77» twice.
server «ip|8 dot 8 dot 4 dot 4» replied
Charge «card|4111.1111.1111.1111» please.
Visa «card|4012/8888/8888/1881» expires soon.
The card «card|5555_5555_5555_4444» was declined.
"""

CLEAN = """
Log entry 05 10:22:33 shows nothing odd.
Started 2024-03-05 10:22:33, ended 2024-03-05 11:02:10.
See ISBN 978-3-16-148410-0 for the details.
The older ISBN 3-16-148410-0 is out of print.
SSN 123-45-6789 is a famous example.
The town had 234,567,890 visitors, or so they say.
Revenue grew to 1.234.567.890 last year.
Look at www.example.com for more.
We met at noon at the station. Dot was late.
The video is available at example.org for a week.
Version 4.12.3 fixes issue 10293.
Order 10029384 shipped on 12/05/2023 at 14:05.
The final score was 3-2-1-0 after four rounds.
Coordinates 48.8566, 2.3522 lie in Paris.
Invoice 2023-0047-18 is due on 01.02.2024.
From 1914-07-28 to 1918-11-11 there was war.
He read pages 102, 110, 121, 140 of the book.
Mix 10:20:30:40 parts by weight.
The file has 16777216 bytes in 4096 blocks.
IBAN DE89 3704 0044 0532 0130 00 belongs to nobody.
Tracking number 9400 1000 0000 0000 0000 00 was lost.
Room 12, floor 3, seat 45, row 7.
pi is 3.14159265358979 and e is 2.71828182845905.
The serial 1234-5678-90 is on the back.
Meet us at booth 12 dot matrix printers are there.
Table 4.3.2.1-5 lists all 1,024 cases.
token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" was revoked.
Their prices, 1,299.00 and 2,499.00, went up 12.5 percent.
Published 1998, reprinted 2003, 2007, 2011.
He was born 12. 3. 1975 and died 4. 10. 2019.
"""


def marked(line: str) -> tuple[str, set]:
    text, spans, at = "", set(), 0
    for m in re.finditer(r"«(email|ip|card|phone)\|(.*?)»", line):
        text += line[at : m.start()]
        spans.add((pii.KINDS.index(m[1]), len(text), len(text) + len(m[2])))
        text += m[2]
        at = m.end()
    return text + line[at:], spans


def test_sentences_written_by_hand():
    model, hit, wrong, missed = pii.trained(), [], [], []
    for line in (MARKED + CLEAN).strip().splitlines():
        text, want = marked(line)
        base, spans = pii.all_spans(text, model)
        assert not base or not want, line
        got = set(spans) - set(base)
        show = lambda found: [(pii.KINDS[k], text[s:e]) for k, s, e in sorted(found)]  # noqa: E731, B023
        hit += show(got & want)
        wrong += show(got - want)
        missed += show(want - got)
    print(f"precision {len(hit) / (len(hit) + len(wrong)):.3f}, recall {len(hit) / (len(hit) + len(missed)):.3f}", wrong, missed)
    assert len(hit) / (len(hit) + len(wrong)) >= 0.9 and len(hit) / (len(hit) + len(missed)) >= 0.85, (wrong, missed)


def test_cards_side_by_side():
    model, text = pii.trained(), "de mentle 7536784127813050 4845168114407329 èaique"
    base, spans = pii.all_spans(text, model)
    assert not base and [(pii.KINDS[k], text[s:e]) for k, s, e in spans] == [("card", "7536784127813050"), ("card", "4845168114407329")]
