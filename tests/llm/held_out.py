"""Labelled lines that the CRF never sees in training; none is modelled on the test tables."""

HELD_OUT = """
password = '{secret:correcthorse}'
the password for the router is {secret:Gr33nApple!}
Passwort = "{secret:Winter-Wald-7}"
contraseña {secret:gato_negro55}
api-key: "{secret:pk_test_0aVx91QmLz34TbYw}"
secret_key = {secret:8f14e45fceea167a5a36dedd4bea2543}
the token is {secret:xoxb-2048-7731-AbCdEfGhIjKl}
passphrase "{secret:seven tall quiet horses}"
export AUTH_TOKEN={secret:c0ffee12deadbeef34567890abcdef12}
pin: {secret:9071}
IBAN {account:NL91ABNA0417164300}
IBAN NL: {account:NL91 ABNA 0417 1643 00}
please wire to {account:BE68539007547034} soon
Konto {account:648479930} gehört uns
account {account:4402-118-93} is overdrawn
iban: {account:IT60X0542811101000000123456}
SWIFT {account:CHASUS33XXX}
passport {identity:X1234567}
Reisepass: {identity:C4J0K1L2M}
SSN {identity:457-55-5462}
with number {identity:531-20-7788} in the file
DNI: {identity:87654321X}
driving licence {identity:SMITH852037JR9AB}
social security {identity:987-65-4320}
taxpayer id {identity:98-7654321}
Mr {person:Oliver Stone} called
Mrs {person:Grace Hopper} replied
name: {person:Tomás Rivera}
Frau {person:Ursula Weber} kam
Monsieur {person:Henri Laurent} parle
contact {person:Sarah Miller}, editor
Dr {person:Nakamura} wrote
lives at {address:88 Cherry Lane}
address: {address:402 Pine Street}
wohnt {address:Bahnhofstraße 21} hier
Adresse: {address:Ahornweg 7}
habite {address:27 rue de la Paix} maintenant
vive en {address:calle Luna 9} hoy
moved to {address:3 Station Road} last year
"""
CLEAN = """
in 1805 the fleet had 33 ships and 2,148 guns
the second key point is on page 9
he opened an account in 2 days, she said
chapter 12 names 4 streets of the town
a password of 12 characters is long enough
the road to the coast takes 3 hours
she gave her name and left at 7
version 4.1.2 of the program needs java 17
on 24/12/2020 about 3,000 people came
the secret of the 9 towers is old
im Kapitel 5 steht der Weg nach Rom
le compte rendu de 1998 est perdu
la calle tenía 20 casas y 2 plazas
the licence of 2003 was renewed
table 3 and figure 14b show 0.75
for id 17 see the notes of 1911
"""
