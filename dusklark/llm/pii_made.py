"""Made-up labelled sentences for training: ordinary contexts that the frames of :mod:`dusklark.llm.pii_labels` don't have.

A pattern is a sentence with slots such as ``{name}``; what a slot is filled with is a labelled span. Names, streets,
towns and hosts are drawn from short lists or put together from syllables, numbers are drawn digit by digit, and the
sentences of a text are drawn independently, so that contexts, fillings and neighbours combine freely.
"""

from __future__ import annotations

import regex
from numpy.random import Generator

# Common given and family names, and syllables of others.
_GIVEN_EN = "James Mary Robert Linda Michael Susan William Karen David Nancy Richard Lisa Joseph Betty Thomas Sandra Charles Ashley Daniel Emily Matthew Donna Anthony Carol Mark Amanda Steven Laura Andrew Rachel Paul Olivia Kevin Grace Brian Chloe George Megan Edward Hannah Ryan Priya Omar Fatima Chen Sofia Diego Yuki Ivan Amara".split()
_FAMILY_EN = "Smith Johnson Williams Brown Jones Garcia Miller Davis Wilson Anderson Taylor Thomas Moore Martin Jackson Thompson White Harris Clark Lewis Robinson Walker Young Allen King Wright Scott Hill Green Adams Baker Nelson Hall Rivera Campbell Mitchell Roberts Phillips Evans Turner Parker Collins Edwards Stewart O'Brien O'Connor MacLeod Singh Patel Kowalski".split()
_GIVEN_DE = "Anna Lukas Sabine Jürgen Petra Stefan Ursula Klaus Monika Wolfgang Claudia Andreas Birgit Uwe Heike Markus Katrin Dieter Silke Tobias Anja Sebastian Julia Florian Lena Jonas Greta Moritz Käthe Björn Günther Annika".split()
_FAMILY_DE = "Schmidt Schneider Fischer Weber Meyer Wagner Becker Schulz Hoffmann Schäfer Koch Bauer Richter Klein Wolf Schröder Neumann Schwarz Zimmermann Braun Krüger Hofmann Hartmann Lange Krause Lehmann Köhler Herrmann König Walter Huber Kaiser".split()
_FAMILY_KO = "김 이 박 최 정 강 조 윤 장 임 한 오 서 신 권 황 안 송 류 홍 전 고 문 손 양 배 백 허 남 심 남궁 황보 제갈 선우".split()
_SYLLABLES_KO = "민 서 준 지 현 수 영 은 혜 진 우 성 호 연 아 도 윤 하 재 경 희 동 상 미 나 주 태 훈 예 원 유 빈 슬 기 철 숙 정 선 규 찬".split()
_HEADS = "Bra Ker Lin Mor Tal Ves Gun Hal Fre Ost Pel Rin Sal Tor Wen Yar Zan Dor El Fa Gre Ho Jo Ka Lo Mi Na Or Thi Que Sha Vi".split()
_TAILS = "len den mar son ric wick ford by hart mann stein ley more well dorf ne ra lia ton bert ina el us a o ski ova ez".split()
_STREET_EN = "Oak Maple Cedar Pine Elm Church Mill Park River Station High Market Bridge Garden Chapel Harbour Orchard Willow Sunset Lincoln Washington Victoria".split()
_WAY_EN = "Street St. St Road Rd. Rd Avenue Ave Ave. Lane Ln Drive Dr. Boulevard Blvd Court Close Place Way Row Terrace Square".split()
_TOWN_EN = "Boston Leeds Portland Denver Bristol Austin Salem York Chester Oxford Madison Dover Albany Norwich Cardiff Tulsa".split()
_STREET_DE = "Haupt Bahnhof Garten Schul Berg Linden Wald Kirch Mühlen Rosen Goethe Schiller Ring Park Brunnen Feld".split()
_TOWN_DE = "Berlin München Köln Hamburg Leipzig Dresden Bremen Essen Bonn Mainz Ulm Kassel Erfurt Freiburg".split()
_TOWN_KO = "서울시 부산시 대구시 인천시 수원시 서울특별시 부산광역시 성남시 고양시 전주시".split()
_DISTRICT_KO = "강남구 마포구 해운대구 종로구 서초구 송파구 수성구 연수구 팔달구 분당구".split()
_STREET_KO = "세종대로 테헤란로 월드컵로 중앙로 가람길 은행나무로 벚꽃길 한강대로 시장길 역삼동 서교동 우동 정자동".split()
_HOSTS = "example.org mail.example web.test post.invalid example.com shop.test corp.example mailbox.example uni.test".split()
_ITEMS = "silken tofu|cream tubs|soft buns|oyster mushrooms|cut salad|beef mince|smoked fillet|leaf mix|Sahnebecher|Milchbrötchen|Eintopf|연두부|단팥빵|훈제 연어|the returned crate|the spare scanner|the blue folder".split("|")

# The contexts.
_EN = """Please contact {name} about the delivery.|My name is {name} and I would like a refund.|I spoke with {name} yesterday.|{name} called twice this morning.|Best wishes, {name}|Yours sincerely,
{name}|Thank you, {name}!|Dear {name}, we received your order.|Dear Mr. {name}, your parcel is late.|Mr. {name} and Ms. {name} signed the form.|The ticket was opened by {name}.|It was approved by {name} on Friday.|According to {name}, the shelf was empty.|{name} lives at {address}.|Ship it to {name}, {address}.|Send the invoice to {name}, {address}, before noon.|His address is {address}.|We moved to {address} last spring.|Our new office: {address}|Please deliver to {address}.|You can email me at {email}.|Write to {email} or call {phone}.|My email is {email}, my phone number is {phone}.|email {email}|E-mail: {email}
Phone: {phone}|Contact: {name} <{email}>|{name} ({email}) asked for a copy.|Call me back on {phone}, please.|Her number is {phone}.|You can reach us at {phone}.|phone: {phone}|cell {phone}|Fax {phone}|My SSN is {ssn}.|SSN: {ssn}|social security number {ssn} was on the form|The tax number {tax} is wrong.|Passport or ID number {tax}.|national insurance record {ssn}|Tax ID {tax}|He gave his identity card number as {tax}.|Signed: {name}|from {name} to {name}|cc: {name}, {name}|Forwarded by {name} on behalf of {name}.|Ask {name} or {name} for the key.|{name}'s order came twice.|We met {name}'s team at noon.|Is {name} in today?|with {name} at the desk|I think {name} knows.|meeting with {name} and {name} at 10:30|Employee: {name}, id {tax}, phone {phone}|name={name}; mail={email}; tel={phone}|{name}, {phone}|{name} - {email}|Customer {name} of {address} called from {phone}.|she asked {name} to check the stock|Regards,
{name}
{phone}
{email}|Patient {name} was born in 1984.|The driver, {name}, left at 14:05.|Hello {name}, thanks for your note.|{name} wrote: the boxes were wet.|Our neighbour {name} took the parcel.|Visit us at {address}, open daily.|The store at {address} closes early.""".split("|")
_DE = """Mein Name ist {name}.|Ich heiße {name} und warte auf die Lieferung.|Bitte wenden Sie sich an {name}.|Herr {name} hat angerufen.|Frau {name} ist im Urlaub.|Sehr geehrte Frau {name}, vielen Dank.|Sehr geehrter Herr {name}, Ihre Bestellung ist da.|Liebe Grüße
{name}|Viele Grüße, {name}|Das Paket nahm {name} an.|{name} wohnt in der {address}.|Die Adresse lautet {address}.|Liefern Sie bitte an {name}, {address}.|Wir sind umgezogen: {address}|Meine E-Mail ist {email}.|Schreiben Sie an {email} oder rufen Sie {phone} an.|Meine Telefonnummer ist {phone}.|Handy: {phone}|Sie erreichen mich unter {phone}.|Steuernummer {tax}|Die Steuer-Identifikationsnummer lautet {tax}.|Sozialversicherungsnummer: {tax}|Ausweis Nr. {tax}|Gestern sprach ich mit {name} über {item}.|Laut {name} fehlten zwei Kisten.|{name} und {name} kamen zu spät.|Kontakt: {name}, {phone}, {email}|im Auftrag von {name}|unterschrieben von {name}|Der Kunde {name} aus {address} will sein Geld zurück.|Kollegin {name} prüft das.|{name} sagte, {item} sei ausverkauft.|Hallo {name}, danke für die Nachricht.""".split("|")
_KO = """저는 {ko}입니다.|제 이름은 {ko}이에요.|제 전화번호는 {phone}이고 급합니다.|제 전화번호는 {phone}입니다.|제 이메일은 {email}입니다.|{ko} 씨가 전화했습니다.|{ko}님께서 문의하셨습니다.|{ko} 고객님 안녕하세요.|{ko} 대리에게 전달해 주세요.|{ko}과 {ko}가 회의에 참석했습니다.|담당은 {ko}이고 연락처는 {phone}입니다.|전화 {phone}|휴대폰: {phone}|이메일 {email}로 보내 주세요.|{email}으로 답장 주세요.|주소는 {kaddress}입니다.|{kaddress}로 보내 주세요.|저희 집은 {kaddress}에 있습니다.|{kaddress}에 사는 {ko}입니다.|주민번호 {rrn}|주민등록번호는 {rrn}입니다.|주민등록번호: {rrn}|신분증 번호는 {rrn}였습니다.|어제 {ko}한테 들었어요.|{ko} 올림|작성자: {ko}|{ko}의 주문이 두 번 왔습니다.|{ko}이 창고에 있습니다.|{ko}은 오늘 쉽니다.|이름 {ko}, 번호 {phone}|받는 사람: {ko}
주소: {kaddress}
전화: {phone}|기사님 성함은 {ko}입니다.|환불은 {ko} 이름으로 해 주세요.|새 직원 {ko}을 소개합니다.""".split("|")
_NONE = """The delivery of {item} was late again.|We sold {n} packs before {t}.|Order {lot} has not shipped yet.|Invoice {lot} totals {n},{n3} won.|Version {n}.{n}.{n} was rolled back.|The meeting is at {t} on {d}.|Please restock {item} by Friday.|Good Morning Bakery opened on Main Street.|The Market Hall team won the Spring Award.|See page {n} of the manual.|Tracking {lot}, {n} kg.|lot {lot} expired {d}|Temperature {n}.{n} degrees at {t}.|Nobody answered the phone.|Send an email to the office when it is done.|The address label was torn.|The customer asked for a refund.|Her name was not on the list.|No SSN was given; the field says ***-**-****.|The manager and the driver talked about {item}.|Please call the desk before noon.|I will be back on Monday.|Thanks for the quick reply!|New York prices rose by {n} %.|On {d} we counted {n} crates of {item}.|Die Lieferung von {item} kam um {t} Uhr.|Rechnung {lot} vom {d}|Bitte rufen Sie uns an.|Der Kunde war nicht zu Hause.|Vielen Dank und bis Montag.|Am {d} fehlten {n} Stück.|Die Straße war gesperrt.|Unsere Filiale in Hamburg schließt um {t} Uhr.|오늘은 {item} 재고가 없습니다.|배송이 {n}일 늦었습니다.|송장 번호 {lot} 확인 부탁드립니다.|전화를 받지 않습니다.|고객이 환불을 요청했습니다.|안녕하세요, 문의드립니다.|회의는 {t}에 시작합니다.|매장은 {d}에 쉽니다.|주소를 다시 확인해 주세요.|감사합니다.|SKU {n3}{n3}{n} at {n}% off|Gate code {n}{n}, aisle {n}.|It costs ${n}.{n} per pack.|GTIN {lot}{n3}|Ticket #{n3}{n} was closed.|Room {n} on floor {n} is free.""".split("|")
# Parts of which further contexts are put together.
_ROLE_EN = "the landlord|her boss|our neighbour|the witness|a colleague|my brother|his aunt|the new hire|the inspector|their lawyer|the tenant|the trainee|a visitor|the buyer|the supplier|a teacher|the pharmacist|the caller|the owner|the accountant|the mechanic|our guest".split("|")
_DID_EN = "returned the crate|was early|paid in cash|forgot the keys|sat by the window|will retire soon|has signed the lease|complained again|knows the code|bought two cakes|saw the spill|won the raffle|says it was peeling|left a note|is on holiday|checked the scales|opened the gate|reported a leak|had no badge|joined in May|cancelled the order|came by after lunch|broke the printer|wants a receipt".split("|")
_WITH_EN = "we interviewed|I met|they hired|she drove with|nobody told|we thanked|the letter names|the report mentions|ask for|statement given by|a note from|a parcel for|refund for|lunch with|photos by|the lease names|he sat next to|I waited for|questions go to|after a call with".split("|")
_ROLE_DE = "der Vermieter|die Nachbarin|unser Kollege|die Zeugin|der Mieter|die Chefin|mein Bruder|die Ärztin|der Lehrling|die Verkäuferin|der Lieferant|ihre Kundin|der Anwalt|die Fahrerin|der Hausmeister|die Aushilfe".split("|")
_DID_DE = "hat bezahlt|kam zu früh|wartet noch|hatte keinen Schlüssel|hat unterschrieben|ist krank|fehlt heute|räumt das Lager auf|beschwerte sich|kennt den Code|ging nach Hause|bestellte zwei Torten|hat angerufen|fand die Rechnung|ist seit Mai dabei|prüft die Waage".split("|")
_WITH_DE = "ich traf|wir sprachen mit|gesehen hat es|das Paket ist für|eine Notiz von|fragen Sie|zugestellt an|im Lager stand|Rückfragen beantwortet|der Fahrer hieß|gesprochen habe ich mit|gestern half".split("|")
_BEFORE_KO = "어제|오늘 아침|신입 사원|옆 부서|담당자|택배 기사|우리 팀|환불 받을 사람은|지난주에|매장에서|점장|거래처|예금주는|같이 온 사람은|경비원|방문객".split("|")
_AFTER_KO = " 씨를 만났습니다| 팀장이 승인했습니다|이 출근했어요|가 다녀갔습니다|입니다|에게 전달했어요| 과장과 통화했습니다|님이 기다리십니다|의 가방입니다|이 결제했습니다|가 신고했습니다| 사원이 확인했어요|한테 물어보세요| 앞으로 남겨 주세요|이라고 합니다|은 퇴근했습니다".split("|")
_MORE = """The form lists {ssn} as the social security number.|{ssn} is the SSN on the card.|SSN is {ssn}, not the other one.|social security says {ssn}|Type {ssn} into the SSN field.|the applicant's number is {ssn} (social security)|tax number {tax} was rejected by the portal|Auf dem Antrag stand die Steuernummer {tax}.|서류에 적힌 주민등록번호 {rrn}은 틀렸습니다.|For questions, email {email} before {d}.|Anyone can email {email} for a badge.|Reply-to is {email}, not the old one.|Angebote bitte an {email} senden.|견적서는 {email}로 부탁드립니다.|Text {phone} when you open the gate.|Voicemail from {phone}: call back.|Emergency number {phone}|Rückfragen unter {phone} bei {name}.|Ruf mich an: {phone}|문자는 {phone}로 주세요.|대표 번호 {phone}는 통화 중입니다.|Return address: {address}|They rent the shop at {address} near the canal.|A card was left at {address}, but nobody came.|Sein Büro liegt in der {address}.|Die Filiale eröffnet in der {address}.|{name}, {address}, complained.|Zustellung an {name}, {address}.|택배를 {kaddress}에 놓고 갔습니다.|사무실은 {kaddress}에 있어요.|{name} and {name} saw it.|{ko}과 {ko}이 같이 왔습니다.""".split("|")
_NOT = """Order no. {lot} is still open.|Bestellung {lot} wurde um {t} Uhr storniert.|account {lot} was billed|Sendung {lot} ist unterwegs.|The fair on Mill Street drew a crowd.|Voicemail was full again.|Die Fragen gehen an den Einkauf.|Der Einkauf hat die Ware geprüft.|서류에 적힌 날짜는 {d}입니다.|팀장이 승인했습니다.|Kein Kunde war da, die Ware kam am {d}.|주문 번호 {lot} 취소됨|My supervisor has approved it.|The applicant came late.""".split("|")
# Nouns of contexts without any span; German writes them all with a capital.
_NOUN_DE = "Regal Lager Preis Filiale Kunde Ware Lieferung Rechnung Kühlraum Etikett Bestand Angebot Schicht Waage Kiste Palette Rampe Tor Zettel Drucker Büro Montag Ende Anfang Juni März Sommer Stunde Frist Vertrag Schlüssel Meldung Bericht Zählung Kasse Tür Fenster Lieferschein Auftrag Markt Umsatz Verlust Rest Vorrat Beutel Gang Halle Abteilung Behörde Amt Schule".split()
_NOUN_EN = "Shelf Price Store Stock Label Printer Freezer Gate Aisle Crate Pallet Ramp Counter Oven Batch Sales Returns Deliveries Messages Boxes Staff Visitors Customers Managers Parents Everyone Somebody Neither Most Several Yesterday Today Tomorrow Monday Friday Spring August Festival Council Bakery Harbour Museum Library Station Committee".split()
_SLOT = regex.compile(r"\{(\w+)\}")
_KIND = {"name": "name", "ko": "name", "email": "email", "phone": "phone", "ssn": "id_number", "tax": "id_number", "rrn": "id_number", "address": "address", "kaddress": "address"}


class Maker:
    """Draws texts with their spans."""

    def __init__(self, rng: Generator):
        self.rng = rng

    def pick(self, options: list[str]) -> str:
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def digits(self, pattern: str) -> str:
        """``9`` is any digit, ``8`` one that isn't 0; other characters stay."""
        return "".join(str(int(self.rng.integers(10))) if c == "9" else str(int(self.rng.integers(1, 10))) if c == "8" else c for c in pattern)

    def word(self) -> str:
        return self.pick(_HEADS) + (self.pick(_TAILS) if self.chance(0.9) else "") + (self.pick(_TAILS) if self.chance(0.3) else "")

    def name(self) -> str:
        german = self.chance(0.35)
        given = self.word() if self.chance(0.45) else self.pick(_GIVEN_DE if german else _GIVEN_EN)
        family = self.word() if self.chance(0.5) else self.pick(_FAMILY_DE if german else _FAMILY_EN)
        if self.chance(0.06):
            family = f"{family}-{self.word()}"
        way = self.rng.random()
        if way < 0.60:
            out = f"{given} {family}"
        elif way < 0.68:
            out = f"{given} {given[0]}. {family}"
        elif way < 0.75:
            out = f"{given[0]}. {family}"
        elif way < 0.80:
            out = f"{family}, {given}"
        elif way < 0.90:
            out = family
        else:
            out = given
        return out.upper() if self.chance(0.03) else out

    def ko(self) -> str:
        return self.pick(_FAMILY_KO) + self.pick(_SYLLABLES_KO) + (self.pick(_SYLLABLES_KO) if self.chance(0.93) else "")

    def email(self) -> str:
        user = (self.word() if self.chance(0.5) else self.pick(_GIVEN_EN)).lower()
        user = self.pick([user, f"{user}.{self.word().lower()}", f"{user[0]}.{self.word().lower()}", f"{user}{self.digits('99')}", f"{user}_{self.digits('9')}", f"{user}-{self.word().lower()}", f"info+{user}"])
        host = self.pick(_HOSTS) if self.chance(0.5) else f"{self.word().lower()}.{self.pick(['com', 'org', 'de', 'net', 'co.kr', 'co.uk', 'io', 'test'])}"
        if self.chance(0.1):
            return f"{user} (at) {host}" if self.chance(0.5) else f"{user} at {host.replace('.', ' dot ')}"
        return f"{user}@{host}"

    def phone(self) -> str:
        return self.digits(self.pick(["010-8999-9999", "010 8999 9999", "01089999999", "02-899-9999", "031-899-9999", "+82 10 8999 9999", "+82-10-8999-9999", "(02) 899-9999", "202-555-0199", "(415) 555-0199", "+1 415 555 0199", "1-800-555-0199", "415.555.0199", "4155550199", "+49 30 8999999", "030 8999999", "030/89999999", "0171 8999999", "+49 171 8999999", "(089) 899 99 99", "+44 20 8999 9999", "020 8999 9999", "07899 899999", "+33 1 89 99 99 99", "089-8999999"]))

    def ssn(self) -> str:
        return self.digits(self.pick(["899-99-9999", "899-99-9999", "899 99 9999", "899999999"]))

    def tax(self) -> str:
        return self.digits(self.pick(["89 999 999 999", "89999999999", "899/999/99999", "8999 9999 9999", "99-8999999", "89 8999 99 999", "899-99-9999", "8999999999", "899999-8999999"]))

    def rrn(self) -> str:
        return f"{int(self.rng.integers(40, 100))}{int(self.rng.integers(1, 13)):02d}{int(self.rng.integers(1, 29)):02d}" + self.digits(self.pick(["-8999999", "-8999999", "8999999", " - 8999999"]))

    def address(self) -> str:
        if self.chance(0.35):
            street = self.pick(_STREET_DE) + self.pick(["straße", "str.", "weg", "gasse", "allee", "platz"]) if self.chance(0.8) else f"Am {self.word()}"
            out = f"{street} {self.digits(self.pick(['8', '89', '899', '89a']))}"
            return out + (f", {self.digits('89999')} {self.pick(_TOWN_DE) if self.chance(0.7) else self.word()}" if self.chance(0.75) else "")
        street = self.pick(_STREET_EN) if self.chance(0.6) else self.word()
        way = self.pick(_WAY_EN)
        number = self.digits(self.pick(["8", "89", "899", "8999", "89B"]))
        flat = self.pick(["Apt. 8, ", "Flat 8, ", "Unit 89, ", "Suite 899, "]) if self.chance(0.12) else ""
        out = f"{self.digits(flat)}{number} {street} {way}"
        town = self.pick(_TOWN_EN) if self.chance(0.7) else self.word()
        tail = self.rng.random()
        if tail < 0.25:
            return out
        if tail < 0.5:
            return f"{out}, {town}"
        if tail < 0.8:
            return f"{out}, {town} {self.digits('99999')}" if self.chance(0.5) else f"{out}, {town}, {self.pick(['MA', 'TX', 'OR', 'CA', 'NY'])} {self.digits('99999')}"
        return f"{out}, {town} {self.pick(['LS', 'YO', 'BS', 'OX'])}{self.digits('8 9')}{self.pick(['AB', 'QT', 'XD'])}"

    def kaddress(self) -> str:
        town = (f"{self.pick(_TOWN_KO)} " if self.chance(0.7) else "") + (f"{self.pick(_DISTRICT_KO)} " if self.chance(0.8) else "")
        street = self.pick(_STREET_KO) if self.chance(0.6) else self.pick(_SYLLABLES_KO) + self.pick(_SYLLABLES_KO) + self.pick(["로", "길", "동", "대로"])
        out = f"{town}{street} {self.digits(self.pick(['8', '89', '899', '89-8']))}"
        if self.chance(0.15):
            out += "번지"
        return out + (self.digits(self.pick([" 899호", ", 899호", " 899동 899호"])) if self.chance(0.3) else "")

    def item(self) -> str:
        return self.pick(_ITEMS)

    def n(self) -> str:
        return self.digits(self.pick(["8", "89"]))

    def n3(self) -> str:
        return self.digits("999")

    def lot(self) -> str:
        return self.digits(self.pick(["8-999-9999", "8999 9999 9999", "89999999", "A8-9999-99", "8999-99", "899999999999"]))

    def t(self) -> str:
        return f"{int(self.rng.integers(0, 24)):02d}:{self.pick(['00', '05', '15', '30', '45'])}"

    def d(self) -> str:
        m, day = int(self.rng.integers(1, 13)), int(self.rng.integers(1, 29))
        return self.pick([f"2026-{m:02d}-{day:02d}", f"{day:02d}.{m:02d}.2026", f"{m}/{day}", f"{m}월 {day}일"])

    def pattern(self) -> str:
        """A sentence with slots: a listed one, or one put together around a name."""
        way = self.rng.random()
        if way < 0.1:
            a, b, c = (self.pick(_NOUN_DE) for _ in range(3))
            x, y = self.pick(_NOUN_EN), self.pick(_NOUN_EN)
            return self.pick([f"Im {a} fehlt ein {b}.", f"Beim {a} gab es {{n}} {b}.", f"{a} und {b} liegen am {c}.", f"Die {a} vom {b} ist da.", f"Das {a} kam bis {b} {c}.", f"{x} near the {y.lower()} was moved.", f"{x} and {y.lower()} changed at {{t}}.", f"The {x} {y} closes early.", f"Both {x.lower()} and {y} were late.", f"{x}: {{n}} checked by the night shift."])
        if way < 0.55:
            return self.pick(_NONE if way < 0.21 else _NOT if way < 0.24 else _EN if way < 0.33 else _DE if way < 0.39 else _KO if way < 0.46 else _MORE)
        if way < 0.78:
            role, did, met = self.pick(_ROLE_EN), self.pick(_DID_EN), self.pick(_WITH_EN)
            out = self.pick([f"{role}, {{name}}, {did}.", f"{role} {{name}} {did}.", f"{{name}} {did}.", f"{{name}} {did} and {{name}} {self.pick(_DID_EN)}.", f"{met} {{name}} who {did}.", f"{met} {{name}}.", f"{met} {role} {{name}}.", f"{met} {{name}} and {{name}}.", f"{role} {did}.", f"{met} {role}."])
        elif way < 0.9:
            role, did, met = self.pick(_ROLE_DE), self.pick(_DID_DE), self.pick(_WITH_DE)
            out = self.pick([f"{role} {{name}} {did}.", f"{{name}} {did}.", f"{role}, {{name}}, {did}.", f"{met} {{name}}.", f"{met} {{name}}, der {did}.", f"{met} {{name}} und {{name}}.", f"{role} {did}.", f"{met} {role}."])
        else:
            return self.pick([f"{self.pick(_BEFORE_KO)} {{ko}}{self.pick(_AFTER_KO)}.", f"{{ko}}{self.pick(_AFTER_KO)}.", f"{self.pick(_BEFORE_KO)} {{ko}}{self.pick(_AFTER_KO)}."])
        return out[0].upper() + out[1:]

    def sentence(self) -> tuple[str, list[tuple[int, int, str]]]:
        pattern = self.pattern()
        out, spans, at, size = [], [], 0, 0
        for m in _SLOT.finditer(pattern):
            filled = getattr(self, m[1])()
            before = pattern[at : m.start()]
            if filled.endswith(".") and pattern[m.end() : m.end() + 1] == ".":
                filled = filled[:-1]  # one dot ends both the abbreviation and the sentence
            if m[1] in _KIND:
                spans.append((size + len(before), size + len(before) + len(filled), _KIND[m[1]]))
            out += [before, filled]
            size, at = size + len(before) + len(filled), m.end()
        return "".join(out) + pattern[at:], spans

    def text(self) -> tuple[str, list[tuple[int, int, str]]]:
        """One to six sentences with their spans."""
        out, spans = "", []
        joint = self.pick([" ", " ", " ", "\n", "\n\n", " / "])
        for i in range(int(self.rng.integers(1, 7))):
            s, found = self.sentence()
            at = len(out) + (len(joint) if i else 0)
            out += (joint if i else "") + s
            spans += [(a + at, z + at, k) for a, z, k in found]
        return out, spans
