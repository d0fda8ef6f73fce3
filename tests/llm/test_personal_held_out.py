"""Personal information in sentences written by hand, in frames the labelled table does not hold. Spans stand in ⟨kind|text⟩."""

import re

import pytest

from lexmill.llm import personal, personal_table

SENTENCES = """
Le bilan de ⟨n|Thierry Lacombe⟩ sera renvoyé au service dès réception.
Nous remercions le Dr ⟨n|Bouvier⟩ de nous avoir confié cette malade.
Mme ⟨n|Aïcha Benhaddou⟩ signale une gêne à la marche.
Après discussion avec M. ⟨n|Olivier Garnier⟩, l'intervention est repoussée.
Le professeur ⟨n|J. Marchetti⟩ conseille une abstention.
Les parents de ⟨n|Lina Ferrand⟩ ont été informés ce matin.
Compte rendu transmis au Dr ⟨n|Hélène Vasseur⟩ et au Pr ⟨n|Noël⟩.
Dossier suivi par ⟨n|GAUTHIER Monique⟩ au secrétariat.
Une réunion est prévue avec ⟨n|Sébastien Ruffin⟩, éducateur.
Je soussigné ⟨n|Marc Delaunay⟩ certifie avoir examiné l'enfant.
La voisine, Mme ⟨n|Rossignol⟩, a donné l'alerte.
C'est ⟨n|Fabienne Courtois⟩ qui a réalisé la prise de sang.
Depuis sa chute, Mlle ⟨n|Perrin⟩ marche avec une canne.
Avis du Dr ⟨n|de Montalembert⟩ : pas de chirurgie.
⟨n|Kevin Tessier⟩ arrête le sport pour six semaines.
Le rendez-vous de M. ⟨n|Nguyen⟩ est annulé.
Merci de contacter la famille au ⟨p|06 45 87 12 33⟩ avant vendredi.
En cas d'absence laissez un message sur le ⟨p|01.42.77.90.18⟩.
Le numéro du fils est ⟨p|0678123490⟩, celui de la fille ⟨p|+33 7 81 22 90 04⟩.
Urgences dentaires : ⟨p|04-91-33-27-65⟩.
L'ambulance se commande au ⟨p|(03) 88 21 40 09⟩.
Ses coordonnées : ⟨p|0033 1 55 42 10 97⟩, ⟨e|thierry.lacombe@orange.fr⟩.
Le courrier part de ⟨e|secretariat.pneumo@chu-nord.fr⟩ chaque lundi.
Signalez tout effet à ⟨e|vigilance@pharma-sud.com⟩.
Je reste disponible sur ⟨e|m.delaunay78@gmail.com⟩ si besoin.
Pour s'inscrire : ⟨e|atelier-memoire [at] maison-sante.org⟩.
Le compte ⟨e|claire_morin@laposte.net⟩ a été fermé.
Vous trouverez le cabinet au ⟨a|14 rue des Lilas, 69003 Lyon⟩.
Le matériel a été livré ⟨a|8 bis avenue Jean Jaurès, 31000 Toulouse⟩.
Depuis mars elle loge ⟨a|27, boulevard Voltaire⟩ chez sa tante.
L'infirmière passe au ⟨a|3 impasse du Moulin⟩ à 8 h.
Le patient réside ⟨a|112 chemin de la Plaine, 34090 Montpellier⟩.
Facture à envoyer : ⟨a|5 place de la République, 29200 Brest⟩.
Le régime a enregistré le numéro ⟨i|2 84 05 69 123 045 77⟩ hier.
Ayant droit : ⟨i|1 79 11 33 063 221 45⟩.
Elle présente un passeport, ⟨i|19FV48213⟩, encore valable.
La caisse réclame le NIR ⟨i|185027512345688⟩ du conjoint.
Signature de la patiente : ⟨n|Josiane Lemaire⟩, le 3 mars.
Please book ⟨n|Mr Alan Whitfield⟩ for an ultrasound.
The daughter, ⟨n|Rebecca Stone⟩, manages his tablets.
Thanks go to Dr ⟨n|Priya Raman⟩ for the referral.
⟨n|Margaret Hollis⟩ fell in the garden on Sunday.
Mrs ⟨n|O'Connell⟩ declined the vaccine.
His GP, Dr ⟨n|T. Lowry⟩, stopped the statin.
Any concerns should be raised with ⟨n|Simon Carver⟩ on the ward.
Seen with consultant ⟨n|Ahmed Farouk⟩ present.
Home visit requested for ⟨a|22 Albert Road, Leeds LS6 2QT⟩.
Equipment goes to ⟨a|7 Willow Close, Norwich⟩ on Friday.
She gave her address as ⟨a|145 Maple Avenue, Springfield⟩.
Leave a voicemail on ⟨p|020 7946 0123⟩ after six.
His sister answers on ⟨p|+44 7911 123456⟩.
The pharmacy line is ⟨p|(415) 555-0134⟩.
Results go to ⟨e|r.stone@northclinic.co.uk⟩ only.
Forward the scan to ⟨e|imaging at stmarys dot org⟩ today.
Her NHS identifier ⟨i|485 777 3456⟩ was confirmed.
Tax record ⟨i|QQ 12 34 56 C⟩ was attached.
The card shows ⟨i|078-05-1120⟩ on the back.
Die Angehörige, Frau ⟨n|Ilse Brandt⟩, wurde informiert.
Herr ⟨n|Dieter Kowalski⟩ klagt über Schwindel.
Den Bericht hat Dr. ⟨n|Annegret Vogel⟩ unterschrieben.
Bitte Frau ⟨n|Schuster⟩ morgen zurückrufen.
⟨n|Markus Lehmann⟩ stellt sich am Montag vor.
Der Patient wohnt ⟨a|Goethestraße 17, 04109 Leipzig⟩.
Lieferung an ⟨a|Am Stadtpark 5, 90409 Nürnberg⟩.
Die Praxis erreichen Sie unter ⟨p|089 4567890⟩.
Notieren Sie die Nummer ⟨p|+49 170 5551234⟩ bitte.
Anfragen richten Sie an ⟨e|empfang@praxis-vogel.de⟩.
Seine Steuernummer im System: ⟨i|65 929 970 489⟩.
Versichert unter ⟨i|M123456789⟩ seit Januar.
La paciente ⟨n|Rosario Méndez⟩ acude sola.
El doctor ⟨n|Ignacio Valverde⟩ pide una analítica.
Se avisa a la hija, ⟨n|Nuria Sanchís⟩, del ingreso.
Don ⟨n|Eusebio Ríos⟩ prefiere esperar.
Entrega en ⟨a|Calle Mayor, 14, 28013 Madrid⟩ por la tarde.
El domicilio consta como ⟨a|Avenida de América 33⟩.
Puede avisar al ⟨p|612 345 678⟩ a cualquier hora.
El centro responde en ⟨p|+34 93 123 45 67⟩.
Mande la receta a ⟨e|nuria.sanchis@correo.es⟩.
Documento ⟨i|12345678Z⟩ caducado.
El extranjero aporta ⟨i|X1234567L⟩ como prueba.
La signora ⟨n|Ornella Bassi⟩ riferisce cefalea.
Il dott. ⟨n|Renato Colombo⟩ ha firmato.
Ha chiamato il fratello, ⟨n|Walter Grassi⟩.
Spedire a ⟨a|Via Garibaldi, 21, 40121 Bologna⟩.
Il paziente vive in ⟨a|Viale dei Tigli 8⟩.
Lo studio risponde allo ⟨p|051 234567 8⟩ di mattina.
Numero della nuora: ⟨p|347 1234567⟩.
Il referto va a ⟨e|o.bassi@libero.it⟩.
Sul modulo compare ⟨i|BSSRNL60A41A944K⟩ due volte.
A doente ⟨n|Graça Monteiro⟩ recusa a cirurgia.
O dr. ⟨n|Henrique Salgado⟩ pediu análises.
Falou com a neta, ⟨n|Telma Rocha⟩, ontem.
Entregar na ⟨a|Rua do Carmo, 45, 1200-093 Lisboa⟩.
Vive na ⟨a|Avenida dos Aliados 110⟩ com a irmã.
O centro atende pelo ⟨p|+351 213 456 789⟩.
Deixe recado no ⟨p|912 345 678⟩.
Responder a ⟨e|graca.monteiro@sapo.pt⟩.
NIF do cônjuge: ⟨i|245 678 912⟩
De : ⟨n|Lucie Prévost⟩ <⟨e|lucie.prevost@free.fr⟩>
⟨n|BERNARD, Chloé⟩ ; ⟨p|05 56 12 34 56⟩ ; ⟨a|9 quai des Chartrons, 33000 Bordeaux⟩
{"contact": "⟨n|Paul Guérin⟩", "gsm": "⟨p|06.11.22.33.44⟩"}
<li>⟨n|Yvonne Leclerc⟩ — ⟨e|yvonne@leclerc.net⟩</li>
Le syndrome de Raynaud et la maladie de Horton ont été évoqués.
The Glasgow score was 14 and a Foley catheter was placed.
Un Morbus Basedow und das Babinski-Zeichen fehlen.
Composer le 15 en cas de douleur thoracique, sinon le 116 117.
L'essai NCT04280705 a inclus 1 062 patients entre 2019 et 2021.
Prendre Doliprane 1000 mg puis Spasfon pendant 5 jours.
La tension était de 14/8, puis 13/7, à 10 h 30.
ISBN 978-2-294-75123-0, page 412.
La scala di Norton e il segno di Murphy sono negativi.
Escala de Braden de 15 puntos, signo de Homans negativo.
L'enfant a reçu 250 mg d'amoxicilline toutes les 8 heures.
The committee approved protocol 2021-004567-12 in May.
Die Behandlung mit Metformin 500 mg wird in der Schwangerschaft beendet.
Conservar entre 2 y 8 °C, lote 4587921, caducidad 06/2026.
Patiente de 67 ans, diabétique, hospitalisée en cardiologie pour dyspnée.
""".strip().splitlines()
KIND = {"n": "name", "p": "phone", "e": "email", "a": "address", "i": "id_number"}


def parsed(marked):
    text, spans, at = "", set(), 0
    for m in re.finditer(r"⟨(\w)\|([^⟩]*)⟩", marked):
        text += marked[at : m.start()]
        first = re.match(r"(?:Mr|Mrs) ", m.group(2))
        spans.add((len(text) + (first.end() if first else 0), KIND[m.group(1)]))
        text += m.group(2)
        at = m.end()
    return text + marked[at:], spans


@pytest.fixture(scope="module")
def scored():
    rows = [parsed(s) for s in SENTENCES]
    found = personal.Tagger(personal.train()).spans([t for t, _ in rows])
    want = {(i, a, k) for i, (_, s) in enumerate(rows) for a, k in s}
    got = {(i, a, k) for i, s in enumerate(found) for a, _, k in s}
    return rows, want, got


def test_unseen_frames(scored):
    rows, want, got = scored
    assert len(want) >= 100
    wrong = [(rows[i][0], k, rows[i][0][a : a + 20]) for i, a, k in sorted(want ^ got)]
    assert len(want & got) >= 0.9 * len(want), wrong
    assert len(want & got) >= 0.9 * len(got), wrong


def test_frames_are_not_in_the_table():
    for s in SENTENCES:
        parts = [p.strip(" .,:;") for p in re.split(r"⟨[^⟩]*⟩", s)]
        assert not any(len(p) > 14 and any(p in x for x in personal_table.LINES) for p in parts), s


def test_bounds_of_names():
    at = lambda line, text: personal.bounded(line, line.index(text), line.index(text) + len(text))
    assert at("vu par M. Nguyen hier", "M. Nguyen") == 10 and at("Dr de Montal opère", "Montal") == 3 and at("maison de Montal", "Montal") == 10
    assert at("suivi : DE ROSNY Anne", "ROSNY") == 8 and at("Mme la Baronne", "Baronne") == 7


def test_checks_after_decoding():
    f = personal.valid
    assert not f("phone", "978-2-294-75123-0") and f("phone", "06 12 34 56 78") and not f("id_number", "00326") and f("id_number", "12345678Z")
    assert not f("address", "92 cantons") and f("address", "12 rue des lilas") and not f("name", "Lors de") and not f("name", "All'ingresso")
    assert not f("name", "Nutzen", "mit dem ") and f("name", "Brandt", "Frau ") and f("name", "Brandt", "Signé : ") and not f("name", "frágil")


def test_training_repeats_itself():
    one, two = personal.train.__wrapped__((), 1, 2), personal.train.__wrapped__((), 1, 2)
    assert (one.weight == two.weight).all() and one.vocabulary == two.vocabulary
