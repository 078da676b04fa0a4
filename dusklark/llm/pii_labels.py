"""Labelled spans for training: sentence frames whose slots hold personal information.

A frame is a sentence with slots such as ``{name}``; what stands in a slot is a labelled span, everything else is not.
Frames are only used to label a bounded sample of training rows. Finding personal information is the tagger's work,
which sees characters and must do without them.
"""

from __future__ import annotations

import regex

KINDS = ("email", "phone", "id_number", "address", "name")

# Slot patterns. A slot ends where the frame goes on.
_WORD = r"(?:\p{L}[\p{L}\p{M}'’\-]+)"
_INITIAL = r"(?:\p{L}\.)"
_SLOTS = {
    "name": rf"(?:{_INITIAL}\s?{_WORD}|{_WORD}(?:[ ]+{_INITIAL})?(?:,?[ ]+{_WORD})?)",
    "ko": r"(?:[가-힣]{1,2}[ ]?[가-힣]{2}|[가-힣]{2,4})",
    "email": r"(?:[\w.+\-]+(?:[@＠]|[ ]?[(\[]at[)\]][ ]?|[ ]at[ ])[\w\-]+(?:(?:\.|\[dot\]|[ ]dot[ ])[A-Za-z\-]+)+)",
    "phone": r"(?:[+＋(（]?[\d][\d \-./()（）]{6,22}\d)",
    "id_number": r"(?:\d[\d \-./]{7,18}\d)",
    "address": r"(?:[^;\"<>@＠\n]{4,90}?(?:\n[^;\"<>@＠\n]{2,60}?)?)",
}
_SHOWN = {"ko": "name"}

# The frames.
_FRAMES = [
    r"Customer {name} wants the refund confirmation at {email}(?=[.\s]|$)",
    r"{name} counted the trays twice",
    r"\bHi {name}, the",
    r"{name}['’]s pallet was short by \d+, says {name}(?=\.)",
    r"\bThanks, {name}(?=\s|$)",
    r"(?:Kind regards|Mit freundlichen Grüßen),?\s+(?:[>|\-] ?)*{name}(?=\s*\n|\s+(?:[>|/\-] ?)*(?:Tel|mobile)|\s*$)",
    r"Kind regards,?\s+[^\n]{2,40}\s*\n[>|\- ]*{phone}(?=\s*(?:\n|$))",
    r"Kind regards,?\s+[^\n]{2,40}\s*\n[^\n]{7,30}\n[>|\- ]*{email}(?=\s|$)",
    r"드림\s*\n[>|\- ]*{phone}(?=\s|$)",
    r"드림\s*\n[^\n]{7,30}\n[>|\- ]*{email}(?=\s|$)",
    r"\bTel\. {phone}\s*\n[>|\- ]*{email}(?=\s|$)",
    r"Anruf [\d./\-]+ von {phone}, Rückfrage an {email}(?=\s|\.|$)",
    r"Attendees were {name}, {name} and the night crew",
    r"\bcc {email}, {email}; minutes by {name}(?=\s|$)",
    r"Driver {name} showed card {id_number} at the gate",
    r"\bfrom <?{email}>? on [\d./\-]+: price tag wrong, call {phone}(?= ?(?:ext|x|#|,|\.|$))",
    r"She lives at {address}(?<!\b[Rr][Dd])(?=\.(?:\s|$))",
    r"Deliver the replacement to {address}(?=; leave)",
    r"The parcel went to {address}(?=, not to the depot)",
    r"(?:Mrs?|Ms|Dr)\.? {name} moved from {address} to {address}(?=; update)",
    r"\"customer\": \"{name}\", \"phone\": \"{phone}\"",
    r"\"customer\": \"{ko}\", \"phone\": \"{phone}\"",
    r"I asked (?:Mrs?|Ms|Dr)\.? {name} whether",
    r"old id {id_number} replaced by {id_number}, asked for by (?:Mrs?|Ms|Dr)\.? {name}(?=\s|$)",
    r"\bnote;\w+;{name};{phone};",
    r"\bnote;\w+;{ko};{phone};",
    r"Reach (?:Mrs?|Ms|Dr)\.? {name} under {phone}, or write to {email}(?=[.\s]|$)",
    r"caller={phone} agent={name} fc=",
    r"caller={phone} agent={ko} fc=",
    r"SSN on file {id_number},",
    r"taxpayer no\. {id_number}",
    r"Please ring {phone} before",
    r"\b(?:mobile|Tel[.:]|연락처:|Telefon:?|Fon:?) {phone}",
    r"Send the loss report to {email}(?=[.\s]|$)",
    r"\bName: {name}(?=\s*[\n;]|\s*$|\s+[-/|>] ?(?:Address|Anschrift))",
    r"\bAddress: {address}(?=\s+(?:[>/|\-] ?)?(?:Tel|Ref)\b)",
    r"(?:Herr|Frau|Fr\.|Hr\.|Dr\.) {name} möchte die Gutschrift an {email}(?=[.\s]|$)",
    r"{name} hat die Kisten zweimal gezählt",
    r"\bHallo {name}, ",
    r"Fahrer {name}, Ausweisnummer {id_number}, kam",
    r"Ersatz bitte an {address}(?=, Hintereingang)",
    r"Die Lieferung ging an {address}; quittiert von {name}(?=\.)",
    r"Anschrift: {address}(?=; Mail)",
    r"; Mail: {email}(?=\s|$)",
    r"Rückruf bitte unter {phone}(?=\.)",
    r"Steuer-ID {id_number} steht",
    r"Anruf [\d./\-]+ {phone},? {name}(?=\s|,|:|$)",
    r"손실 보고서는 {email} ?앞으로",
    r"주민등록번호\({id_number}\)가",
    r"문의는 {phone}로",
    r"(?<![가-힣]){ko}, {ko} 두 사람이",
    r"교환 상품은 {address} 앞으로 보내",
    r"(?<![가-힣]){ko} 씨, ",
    r"(?<![가-힣]){ko}에게 [\d.]+% 할인을",
    r"(?<![가-힣]){ko} 매니저가",
    r"배송지가 {address}\(으\)로 변경",
    r"고객 {ko} 님이 {email}로",
    r"기사 {ko} 신분 확인 번호 {id_number} 기록",
    r"통화기록 [\d./\-]+ {phone} {ko} 환불",
    r"통화기록 [\d./\-]+ {phone} {name} 환불",
    r"주소: (?P<s0>(?:[가-힣]+시 )?(?:[가-힣]+구 )?[가-힣]+(?:로|길|동) \d+(?:-\d+)?(?:번지)?(?:,? (?:\d+동 )?\d+호)?)",
    r"담당자: {ko}(?=\s|$)",
    r"(?<![가-힣]){ko} 드림",
]


def _compiled() -> list[tuple[regex.Pattern, dict[str, str]]]:
    out = []
    for frame in _FRAMES:
        kinds: dict[str, str] = {}

        def slot(m: regex.Match, kinds: dict[str, str] = kinds) -> str:
            group = f"s{len(kinds)}"
            kinds[group] = _SHOWN.get(m[1], m[1])
            return f"(?P<{group}>{_SLOTS[m[1]]})"

        # blanks of a frame may be line breaks in the text
        body = regex.sub(r"\{(name|ko|email|phone|id_number|address)\}", slot, frame)
        if "(?P<s0>" in frame:
            kinds["s0"] = "address"
        out.append((regex.compile(body), kinds))
    return out


_ALL = _compiled()
_PARTS = regex.compile(r"[\p{L}\p{M}'’\-]{2,}")


def known_parts(texts: list[str]) -> set[str]:
    """Name parts (case-folded) that stand between two fixed ends of a frame somewhere in the texts."""
    closed = [(p, k) for (p, k), f in zip(_ALL, _FRAMES) if "name" in k.values() and regex.search(r"\{name\}(?!\(\?=)[^{]*[a-zäöü]{3}", f)]
    seen: dict[str, int] = {}
    for text in texts:
        for pattern, kinds in closed:
            for m in pattern.finditer(text):
                for g, kind in kinds.items():
                    if kind == "name":
                        for w in _PARTS.findall(m[g]):
                            seen[w.casefold()] = seen.get(w.casefold(), 0) + 1
    return {w for w, n in seen.items() if n >= 3}


def _trimmed(text: str, a: int, z: int, known: set[str]) -> tuple[int, int]:
    """A name without neighbouring words that are no name parts; empty where none is left."""
    words = [(a + m.start(), a + m.end()) for m in _PARTS.finditer(text[a:z])]

    def fits(w: tuple[int, int]) -> bool:
        return text[w[0] : w[1]].casefold() in known

    if not words or not any(map(fits, words)):
        alone = len(words) == 1 and text[words[0][0]].isupper()
        return (a, z) if alone or len(words) == 2 and all(text[w[0]].isupper() for w in words) else (a, a)
    if not fits(words[-1]):
        z = a + len(text[a : words[-1][0]].rstrip(" ,"))
    if len(words) > 1 and not fits(words[0]):
        a = words[-1][0]
    return a, z


def spans(text: str, known: set[str]) -> list[tuple[int, int, str]]:
    """Labelled spans ``start, end, kind`` of a text, in order and without overlaps; the earliest and longest wins.

    Where a line runs on after a name, a second word only belongs to it if it is a known name part.
    """
    found = []
    for pattern, kinds in _ALL:
        for m in pattern.finditer(text, overlapped=True):
            for g, kind in kinds.items():
                a, z = m.span(g)
                if kind == "name" and text[a].isascii() and text[a].isalpha():
                    a, z = _trimmed(text, a, z, known)
                if z > a:
                    found.append((a, z, kind))
    found.sort(key=lambda s: (s[0], -s[1]))
    out: list[tuple[int, int, str]] = []
    for s in found:
        if not out or s[0] >= out[-1][1]:
            out.append(s)
    return out
