"""Sentences with personal data whose labels are known because they were put together that way.

Names, streets, numbers and contexts are drawn from small grammars of several languages. No written form of `pii_forms` takes part,
so the labels do not depend on the check behind the tagger.
"""

from __future__ import annotations

import numpy as np

EMAIL, PHONE, ID, ADDRESS, NAME = range(5)

GIVEN = (
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah Karen "
    "Daniel Nancy Matthew Lisa Anthony Betty Mark Sandra Emily Oliver Amelia Harry Isla Jack Ava Noah Freya Ethan Grace Hans Peter Klaus "
    "Ursula Petra Jürgen Sabine Wolfgang Anke Lukas Leonie Felix Pierre Marie Jean Camille Luc Élise Antoine Chloé Hugo Inès José Carmen "
    "Antonio Lucía Javier Pilar Diego Rocío Pedro Ana João Beatriz Rui Inês Giulia Marco Paola Luca Sven Ingrid Lars Astrid Agnieszka "
    "Piotr Katarzyna Milan Jana Dmitri Olga Wei Ming Yuki Hiroshi Priya Arjun Fatima Omar Layla Yusuf Amina Kwame Chidi Ngozi"
).split()
FAMILY = (
    "Smith Johnson Williams Brown Jones Garcia Miller Davis Martinez Wilson Anderson Taylor Moore Jackson Martin Lee Thompson White Harris Clark "
    "Lewis Walker Hall Young King Wright Hill Scott Green Baker Adams Nelson Carter Mitchell Turner Parker Collins Edwards Stewart Morris Murphy "
    "Cook Rogers Watson Hughes Price Müller Schmidt Schneider Fischer Weber Wagner Becker Hoffmann Schäfer Koch Bauer Richter Klein Wolf "
    "Schröder Neumann Dubois Durand Lefèvre Moreau Laurent Simon Girard Roux Fontaine López González Rodríguez Fernández Sánchez Pérez Gómez "
    "Díaz Ruiz Álvarez Moreno Silva Santos Ferreira Pereira Oliveira Costa Almeida Rossi Russo Ferrari Bianchi Johansson Nilsson Hansen "
    "Kowalski Nowak Novák Dvořák Ivanov Petrova Chen Wang Li Tanaka Sato Suzuki Patel Sharma Singh Khan Haddad Okafor Mensah O'Brien O'Neill"
).split()
TOWN = (
    "London Leeds Bristol York Oxford Manchester Glasgow Cardiff Boston Chicago Denver Austin Portland Springfield Albany Berlin Hamburg München "
    "Köln Leipzig Bremen Dresden Wien Zürich Paris Lyon Nantes Lille Bordeaux Toulouse Madrid Sevilla Valencia Bilbao Málaga Lisboa Porto Coimbra "
    "Roma Milano Torino Utrecht Gent Oslo Malmö Kraków Brno Dublin Cork Toronto Calgary Sydney Perth"
).split()
STREET = "High Oak Mill Church Station Park Maple Elm Cedar Victoria King's Queen's Bridge Baker Hill River Lake Garden Market Castle Chestnut Walnut".split()
COMPANY = "Northwind Acme Globex Initech Contoso Fabrikam Umbra Stellar Horizon Pioneer Beacon Summit Granite Harbour Vertex Orion".split()
#: Running words of several languages.
WORDS = (
    "the a and of to in for with on at by from was is are were has had will would said asked told met saw knew gave took went came left found made "
    "yesterday today later again never always often because while before after when who that this their her his our my your new old long first last "
    "house office report paper letter meeting plan team work school street week year bill contract room door key car train question answer reason "
    "signed paid lives works called wrote moved sold bought waited agreed refused promised arrived teaches reported der die das und mit von für auf "
    "ist war hat wurde nicht heute gestern schon le la les et de du avec pour est était a dans pas hier el los y con para fue en ayer por o que com "
    "um uma não ontem il che per non ieri van het een met niet"
).split()
COMMON = "Project River Moon Silent House Garden Winter Last Golden Night Star Road Letter Stone Summer Red Blue Broken Island".split()


class Draw:
    def __init__(self, seed: int):
        self.r = np.random.default_rng(seed)

    def of(self, xs):
        return xs[int(self.r.integers(len(xs)))]

    def n(self, a: int, b: int) -> int:
        return int(self.r.integers(a, b + 1))

    def d(self, k: int) -> str:
        return "".join(str(x) for x in self.r.integers(0, 10, k))

    def chance(self, p: float) -> bool:
        return bool(self.r.random() < p)

    def invent(self) -> str:
        """A capitalised word nobody has seen."""
        s = "".join(self.of("bcdfghjklmnprstvwz") + self.of(["a", "e", "i", "o", "u", "ai", "ie", "é"]) for _ in range(self.n(1, 3)))
        return (s + self.of(["", "n", "r", "s", "ck", "son", "berg", "ley", "ski", "ez"])).capitalize()

    def word(self, known) -> str:
        return self.of(known) if self.chance(0.65) else self.invent()

    def name(self) -> str:
        g, f = self.word(GIVEN), self.word(FAMILY)
        if self.chance(0.07):
            g += "-" + self.word(GIVEN)
        if self.chance(0.07):
            f += self.of(["-", " "]) + self.word(FAMILY)
        if self.chance(0.06):
            f = self.of(["van ", "de ", "von ", "van der ", "de la ", "di ", "da ", "Mac", "Mc"]) + f
        form = self.r.random()
        if form < 0.1:
            s = f"{g} {self.of('ABCDEFGHJKLMNPRSTW')}. {f}"
        elif form < 0.17:
            s = f"{g[0]}. {f}"
        elif form < 0.23:
            s = f"{f}, {g}"
        elif form < 0.26:
            s = f"{g} {self.word(GIVEN)} {f}"
        else:
            s = f"{g} {f}"
        return s.upper() if self.chance(0.05) else s.lower() if self.chance(0.04) else s

    def email(self) -> str:
        a, b = self.word(GIVEN).lower(), self.word(FAMILY).lower()
        local = self.of([f"{a}.{b}", f"{a[0]}{b}", f"{a}_{b}{self.n(1, 99)}", a, f"{b}{self.n(1970, 2005)}", self.of(["info", "support", "sales", "office", "press", "billing"]), f"{a}+{self.of(['news', 'work'])}"])
        host = self.of([self.of(COMPANY).lower(), self.invent().lower(), "example", "mail", f"{self.invent().lower()}-{self.of(['it', 'media', 'shop'])}"])
        end = self.of(["com", "org", "net", "de", "fr", "es", "co.uk", "io", "eu", "pt", "it", "edu"])
        form = self.r.random()
        if form < 0.8:
            return f"{local}@{host}.{end}"
        if form < 0.9:
            return f"{local}{self.of([' [at] ', '(at)', ' (at) ', '[at]'])}{host}{self.of(['.', ' [dot] ', ' (dot) ', '[dot]'])}{end.replace('.', ' [dot] ')}"
        return f"{local} at {host} dot {end.split('.')[-1]}"

    def phone(self) -> str:
        d = self.d
        s = self.of([
            lambda: f"({self.n(2, 9)}{d(2)}) {d(3)}-{d(4)}", lambda: f"{self.n(2, 9)}{d(2)}-{d(3)}-{d(4)}", lambda: f"{self.n(2, 9)}{d(2)}.{d(3)}.{d(4)}",
            lambda: f"+1 {self.n(2, 9)}{d(2)} {d(3)} {d(4)}", lambda: f"+44 20 {d(4)} {d(4)}", lambda: f"+44 7{d(3)} {d(6)}", lambda: f"020 {d(4)} {d(4)}", lambda: f"07{d(3)} {d(6)}",
            lambda: f"+49 {self.n(30, 89)} {d(self.n(6, 8))}", lambda: f"0{self.n(30, 899)}/{d(self.n(6, 8))}", lambda: f"+49 (0){self.n(30, 899)} {d(3)} {d(4)}", lambda: f"+33 {self.n(1, 9)} {d(2)} {d(2)} {d(2)} {d(2)}",
            lambda: f"0{self.n(1, 9)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"+34 {self.n(6, 9)}{d(2)} {d(3)} {d(3)}", lambda: f"{self.n(6, 9)}{d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"+351 9{d(2)} {d(3)} {d(3)}",
            lambda: f"+39 0{self.n(2, 99)} {d(7)}", lambda: f"00{self.n(31, 49)}{d(9)}", lambda: f"+{self.n(31, 99)}{d(self.n(9, 10))}", lambda: f"1-800-{d(3)}-{d(4)}",
        ])()
        return s + (self.of([f" ext. {self.d(3)}", f" x{self.d(2)}", f" ext {self.d(4)}", f" extension {self.d(3)}"]) if self.chance(0.1) else "")

    def id(self) -> str:
        d, up = self.d, "ABCEGHJKLMNPRSTWXYZ"
        return self.of([
            lambda: f"{self.of(up)}{self.of(up)} {d(2)} {d(2)} {d(2)} {self.of('ABCD')}", lambda: f"{self.of(up)}{self.of(up)}{d(6)}{self.of('ABCD')}", lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: f"{d(8)}{self.of(up)}",
            lambda: f"{self.of('XYZ')}{d(7)}{self.of(up)}", lambda: f"{d(2)} {d(3)} {d(3)} {d(3)}", lambda: f"{self.n(1, 2)} {d(2)} {d(2)} {d(2)} {d(3)} {d(3)} {d(2)}", lambda: f"{d(6)}-{d(4)}", lambda: f"{d(3)}.{d(3)}.{d(3)}-{d(2)}",
            lambda: f"{self.of(up)}{self.of(up)}{d(7)}", lambda: f"{self.of(up)}{d(8)}", lambda: f"DE{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}", lambda: f"GB{d(2)} {self.of(['WEST', 'BARC', 'NWBK'])} {d(4)} {d(4)} {d(4)} {d(2)}"[:-3], lambda: f"ES{d(22)}",
            lambda: f"{self.of(up)}{self.of(up)}{self.of(up)}{self.of(up)}{self.of(up)}{self.of(up)}{d(2)}{self.of('ABCDEHLMPRST')}{d(2)}{self.of('ABCDEFGHIL')}{d(3)}{self.of(up)}",
        ])()

    def address(self) -> str:
        town, no, gap = self.word(TOWN), self.n(1, 299), self.of([", ", ", ", ", ", "\n", ",\n"])
        us, uk = f"{self.of(['NY', 'CA', 'TX', 'OR', 'CO', 'MA', 'IL'])} {self.d(5)}", f"{self.of(['SW', 'LS', 'M', 'BS', 'NW', 'EC', 'G'])}{self.n(1, 19)} {self.d(1)}{self.of('ABDEFGH')}{self.of('ABDEFGH')}"
        way = self.of(["Street", "Road", "Avenue", "Lane", "Drive", "St", "Rd", "Ave", "Close", "Way", "Court", "Boulevard", "Terrace"])
        st = self.word(STREET)
        return self.of([
            lambda: f"{no} {st} {way}{gap}{town}, {us}", lambda: f"{no}{self.of(['', '', 'A', 'B'])} {st} {way}{gap}{town} {uk}", lambda: f"{no} {st} {way}{gap}{town}", lambda: f"{self.of(['Flat', 'Apt', 'Unit'])} {self.n(1, 40)}, {no} {st} {way}{gap}{town} {uk}",
            lambda: f"{no} {st} {way}, {self.of(['Apt', 'Suite', 'Unit'])} {self.n(1, 40)}{gap}{town}, {us}", lambda: f"PO Box {self.n(10, 9999)}{gap}{town}, {us}", lambda: f"{st}{self.of(['straße', 'weg', 'allee', 'gasse', 'platz'])} {no}{gap}{self.d(5)} {town}",
            lambda: f"{self.word(FAMILY)}str. {no}{gap}{self.d(5)} {town}", lambda: f"{no}{self.of(['', ' bis'])}, {self.of(['rue', 'avenue', 'boulevard', 'quai', 'place'])} {self.of(['de la ', 'du ', 'des ', 'de '])}{self.word(STREET)}{gap}{self.d(5)} {town}",
            lambda: f"{self.of(['Calle', 'Avenida', 'Plaza', 'Paseo'])} {self.of(['', 'de ', 'del '])}{self.word(FAMILY)}{self.of([' ', ', '])}{no}{self.of(['', ', 3º B', ', 2º'])}{gap}{self.d(5)} {town}",
            lambda: f"{self.of(['Rua', 'Travessa', 'Avenida'])} {self.of(['da ', 'do ', 'das ', ''])}{self.word(FAMILY)} {no}{gap}{self.d(4)}-{self.d(3)} {town}", lambda: f"{self.of(['Via', 'Piazza', 'Corso'])} {self.word(FAMILY)} {no}{gap}{self.d(5)} {town}",
            lambda: f"{self.word(FAMILY)}{self.of(['straat', 'laan', 'gracht'])} {no}{gap}{self.d(4)} {self.of('ABCD')}{self.of('ABCD')} {town}",
        ])()

    def noise(self) -> str:
        """What looks alike and is none: works, companies, places, versions, sums, tickets, dates."""
        c = self.of
        return c([
            lambda: f'"{c(["The ", ""])}{c(COMMON)} {c(COMMON)}"', lambda: f"{c(COMPANY)} {c(['Ltd', 'GmbH', 'Inc.', 'Media', 'Group', 'Bank', 'Systems'])}", lambda: f"{c(['The ', ''])}{c(COMMON)} {c(['of ', 'and the ', ''])}{self.invent()}",
            lambda: f"{c(['New York', 'San Francisco', 'Los Angeles', 'Hong Kong', 'South Africa', 'United Kingdom', 'Monday Morning', 'Grand Hotel', 'Central Station'])}", lambda: f"{self.invent()}-{self.n(1, 99)}", lambda: f"TICKET-{self.d(5)}",
            lambda: f"#{self.d(6)}", lambda: f"{self.n(1990, 2029)}-{self.n(10, 12)}-{self.n(10, 28)}", lambda: f"{self.n(1, 12)}/{self.n(1, 28)}/{self.n(1990, 2029)}", lambda: f"{self.n(10, 23)}:{self.n(10, 59)}:{self.n(10, 59)}",
            lambda: f"v{self.n(1, 9)}.{self.n(0, 20)}.{self.n(0, 20)}", lambda: f"${self.n(1, 900)},{self.d(3)}.{self.d(2)}", lambda: f"{self.n(1, 999)}.{self.d(3)} EUR", lambda: f"order {self.d(8)}", lambda: f"{self.n(1, 255)}.{self.n(0, 255)}.{self.n(0, 255)}.{self.n(0, 255)}",
            lambda: "".join(c("0123456789abcdef") for _ in range(c([8, 16, 40]))), lambda: f"{self.d(1)}.{self.d(1)} million", lambda: f"@{self.invent().lower()}", lambda: f"https://{self.invent().lower()}.com/{self.n(1, 999)}", lambda: f"{self.n(2, 900)} seeders",
            lambda: f"ISBN 978-{self.d(1)}-{self.d(4)}-{self.d(4)}-{self.d(1)}", lambda: f"invoice {self.n(2019, 2026)}-{self.d(5)}", lambda: f"{c(COMMON)} {c(COMMON)} {self.n(1980, 2026)}",
        ])()


#: Contexts: N name, E e-mail, P phone, I id number, A address, X noise, T title of a person, D a day or time.
CONTEXTS = (
    "N called about X|Please ask N or N|T N will join on D|Met N, head of sales at X, in D|N and N agreed to X|thanks, N|Best regards,\nN|From: N <E>|cc: N, N|N (E)|contact N at E or P|written by N|N's report on X|by N, D|"
    "Dear N,|Hi, my name is N and my number is P|I am N|N lives at A|Send it to N, A|ship to:\nN\nA|Our office: A|The parcel goes to A before D|visit us at A|A is the new address|He moved to A in D|Deliver to A.|located at A, next to X|"
    "call P|Tel.: P|phone: P|Mobile P, fax P|ring me on P after D|you can reach T N on P|Text P or write to E|hotline P|emergency number P|E|mail E for X|write to E|Questions? E|contact: E / P|Email: E\nPhone: P|bounce from E at D|"
    "NI number I|his SSN is I|passport I|passport no. I expires D|tax ID: I|IBAN I|my national insurance number is I|ID card I|personal number I|account I|DNI I|Reisepass I|driver licence I|The applicant N, ID I, born D|"
    "Herr N wohnt in A|Frau N hat angerufen|Ansprechpartner: N, Tel. P|Bitte an E senden|Anschrift: A|Mit freundlichen Grüßen\nN|Rückfragen an N unter P|Steuernummer I|Kontakt: N (E)|Ausweis I von N|"
    "Monsieur N habite A|M. N a signé le D|Contactez N au P|Écrire à E|Adresse : A|numéro de sécurité sociale I|Bien cordialement, N|La candidate N est venue|Signé : N|"
    "El señor N vive en A|Llame al P|Escriba a E|D. N firmó X|Atentamente, N|Dirección: A|DNI: I, N|La doctora N llegó|Fale com N pelo P|Morada: A|O senhor N mora em A|NIF I|CPF I|Il signor N abita in A|codice fiscale I|"
    "W N W|W W N|N W W|W N W N W|W, N, W|N and N W|W N's W|N: W|W by N W|W to N W|W with N|W T N W|W N, W|N, W W|W N|N W|W N. W|"
    "W X W|W W X|X W W|W X, W|W X and X|W X W X|W|W W|W X's W|X: W|W E W|W P W|W I W|W A W|W A, W|"
    "T N|N|N / N / N|1. N\n2. N|N - X|N;E;P|N, A, P|N wrote: X|@N reviewed X|Reviewed-by: N <E>|Approved by N on D|Signed by T N|Witness: N|Patient N, born D, I|Guest N, room 12|Customer N ordered X|N vs. N|interview with N about X|"
    "X is out|watched X yesterday|X and X|we saw X on D|see X|the X was closed|X, X and X|bought from X for X|version X released|error X at D|X moved to X|download X|status of X: open|meeting at X|X (X)|log D X X|price X|room X|"
    "The River Road was closed|Winter Garden opens on D|Report of the Last Night Committee|Golden Star won X|Please read the Terms of Service|Thank You All|Happy New Year|Best Picture went to X|Season Two starts D|Prime Minister spoke|Good Morning Everyone"
).split("|")
TITLES = "Mr. Mrs. Ms. Dr. Prof. Mr Mrs Ms Dr Herr Frau Madame Monsieur Señora Sr. Sra. Dr.".split()
DAYS = "Monday|Tuesday morning|3 May|12 March 2024|10:30|noon|2023|next week|April|Freitag|le 4 mai|mañana|last year|14/02/2022|2024-03-05".split("|")


def sentence(r: Draw) -> tuple[str, list[tuple[int, int, int]]]:
    """(text, spans) of one context filled in."""
    out, spans, n = [], [], 0
    c = r.of(CONTEXTS)
    for i, ch in enumerate(c):
        alone = (i == 0 or not c[i - 1].isalnum()) and (i + 1 == len(c) or not c[i + 1].isalnum())
        kind = {"E": EMAIL, "P": PHONE, "I": ID, "A": ADDRESS, "N": NAME}.get(ch) if alone else None
        if ch == "I" and c[i + 1 : i + 4] == " am":
            kind = None
        if ch == "A" and c[i + 1 : i + 3] == "ll":
            kind = None
        if kind is not None:
            v = (r.email, r.phone, r.id, r.address, r.name)[kind]()
            spans.append((n, n + len(v), kind))
        elif alone and ch == "X":
            v = r.noise()
        elif alone and ch == "T":
            v = r.of(TITLES)
        elif alone and ch == "W":
            v = " ".join(r.of(WORDS) for _ in range(r.n(1, 4)))
        elif alone and ch == "D":
            v = r.of(DAYS)
        else:
            v = ch
        out.append(v)
        n += len(v)
    return "".join(out), spans


def document(r: Draw, size: int) -> tuple[str, list[tuple[int, int, int]]]:
    """(text, spans) of sentences one after the other until `size` characters are reached."""
    text, spans = "", []
    while len(text) < size:
        t, s = sentence(r)
        if r.chance(0.3):
            t, s = t[0].upper() + t[1:] if not (s and s[0][0] == 0) else t, s
        spans += [(a + len(text), b + len(text), k) for a, b, k in s]
        text += t + r.of([". ", ". ", "\n", "\n\n", " ", "; ", ", ", " - ", "! "])
    return text, spans
