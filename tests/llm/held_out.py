"""Texts with marked personal data, written after the rules and without the test tables at hand; `{kind:text}` marks a mention."""

PEOPLE = [
    ("Ingrid", "Halvorsen"), ("Tomasz", "Wieczorek"), ("Priya", "Raghunathan"), ("Desmond", "Okafor"), ("Lucía", "Benavides"), ("Étienne", "Charpentier"), ("Greta", "Lindqvist"),
    ("Noah", "Price"), ("Mary-Ann", "O'Leary"), ("Kenji", "Moriyama"), ("Rosa", "Field"), ("Pieter", "van der Meulen"), ("Aaliyah", "Banks"), ("Sven", "Marsh"),
]

TEXTS = [
    "Please forward the proofs to {email:ingrid.halvorsen@fjord-press.example} before Friday.",
    "The data steward, {name:Tomasz Wieczorek}, can be called on {phone:+48 22 555 01 99}.",
    "Passport number {id_number:X1234567} was copied into the appendix by {name:Priya Raghunathan}.",
    "Send the sample to {address:14 Juniper Lane, Ashbourne}; the lab closes at five.",
    "Yours sincerely,\n{name:Desmond Okafor}\n{phone:(020) 7946 0811}",
    "Escriba a {email:l.benavides@uni.example} o llame al {phone:+34 912 345 678}.",
    "Agradecemos a {name:Lucía Benavides} su lectura del manuscrito.",
    "Nous remercions {name:Étienne Charpentier}, {address:27 rue des Lilas, 69003 Lyon}.",
    "Ansprechpartnerin ist {name:Greta Lindqvist}, {address:Birkenallee 12, 10439 Berlin}, Telefon {phone:030 1234567}.",
    "Reviewer 2 ({name:N. Price}) asked for the raw counts; the price of the probe was not given.",
    "{name:Mary-Ann O'Leary} and {name:Kenji Moriyama} shared the first authorship.",
    "The social security number {id_number:219-09-9999} must not appear in the log.",
    "Contact: {name:Rosa Field}, field office, {phone:415-867-5309}.",
    "We counted 4512 seeds on pages 100-120 and 87 in vol. 12, no. 3.",
    "The ISBN 978-3-16-148410-0 and doi:10.1000/182 identify the same book.",
    "{name:Pieter van der Meulen} wrote to {email:office (at) archive (dot) example} twice.",
    "Dr. {name:Aaliyah Banks} sampled the banks of the river in May and June.",
    "A marsh in the north, near Marsh Road station, was drained by {name:Sven Marsh}.",
    "National insurance: {id_number:AB 12 34 56 C}; the form went to {name:Okafor, Desmond}.",
    "His tax number is {id_number:12-3456789}, as the form shows.",
    "Temperatures of 20.5 and 21.7 were logged at 10:30 and 11:45 on 2019-03-04.",
    "Reach the desk at {phone:+1 800 555 0199} or {email:help@desk.example}.",
    "The consent form of Ms. {name:Raghunathan} lists {address:Flat 3, 8 Orchard Terrace, Whitby}.",
    "Version 3.11.2 was tagged; build 20231105123456 failed.",
    "le numéro de sécurité sociale {id_number:2 55 08 14 168 025 38} figure au dossier.",
    "Thank you, {name:Ingrid}, for the photographs.",
    "Dear Mr. {name:Wieczorek}, your abstract was accepted.",
    "Signed: {name:CHARPENTIER Étienne}",
    "Grant 7654321 and accession AB123456 are cited in the notes.",
    "Domicilio: {address:Calle Alcalá 45, 28014 Madrid}.",
    "call {name:greta lindqvist} about the missing plates",
    "Follow @openarchive or tag release@stable in the issue tracker.",
    "The letter of {name:K. Moriyama} is dated 4 June.",
    "Office: {address:221 Baker Street, London NW1 6XE}.",
    "Identity card {id_number:123-45-6780} belongs to {name:Kenji Moriyama}.",
    "From: {name:Noah Price} <{email:noah.price@mail.example}>",
]


def unmarked(text: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The plain text and its mentions (kind, start, end)."""
    out, marks, size, at = [], [], 0, 0
    while (begin := text.find("{", at)) >= 0:
        end = text.index("}", begin)
        kind, _, inner = text[begin + 1 : end].partition(":")
        out += [text[at:begin], inner]
        size += begin - at
        marks.append((kind, size, size + len(inner)))
        size += len(inner)
        at = end + 1
    return "".join([*out, text[at:]]), marks
