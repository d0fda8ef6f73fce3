"""Classes of words that the features of the recogniser know: forms of address, street kinds, labels, function words and the like.

General vocabulary of six languages; a word is looked up in lower case. A word of two classes belongs to the first that lists it.
"""

from __future__ import annotations

# Frequent given names, most of them French as two thirds of the texts are, some twenty of each other language.
GIVEN = frozenset(
    """
    jean pierre michel philippe alain nicolas christophe laurent julien thomas antoine lucas hugo françois vincent mathieu guillaume marcel bernard jacques
    patrick frédéric stéphane sébastien éric olivier fabrice thierry pascal bruno didier gilles serge yves bastien maxime alexandre quentin romain kevin
    florian damien adrien benjamin louis paul clément thibault rené
    marie nathalie isabelle sylvie catherine céline camille léa chloé manon sophie valérie claire jeanne louise émilie hélène brigitte juliette zoé élodie
    aurélie sandrine caroline virginie anne noémie clara lola jade inès karine corinne fabienne véronique patricia monique nicole solène romane mélanie
    perrine yasmine élise gaëlle amélie
    john james david michael william richard george andrew peter edward oliver daniel mary sarah emma elizabeth margaret jane alice helen emily kate
    hans klaus jürgen wolfgang stefan andreas markus karl heinz jonas sabine monika ursula petra claudia ingrid renate heike greta heidi
    josé antonio manuel juan carlos miguel javier pablo diego fernando carmen lucía pilar dolores elena marta rosa teresa
    giuseppe marco luca francesco giovanni paolo andrea roberto giulia chiara paola sara silvia martina anna maria
    joão pedro rui tiago paulo nuno ana beatriz mariana rita sofia joana
    mohamed karim fatima nadia
    """.split()
)

# Words by class.
CLASSES = {
    "title": """m mm mme mmes mlle monsieur madame mademoiselle dr drs docteur docteure pr prof professeur professeure me maître mr mrs ms miss mister sir
        lady doctor professor nurse sister herr herrn frau doktor schwester sr sra srta señor señora señorita don doña doctora sig sigra signor signora signore
        dott dottssa dottor dottore dottoressa profssa dra senhor senhora dona doutor doutora professora enfermeira infirmière infirmier""",
    "greeting": """merci thanks danke gracias grazie obrigado obrigada bonjour bonsoir hello hi hallo hola ciao olá salut coucou dear cher chère caro cara liebe lieber
        querido querida estimado estimada gentile egregio bonne cordialement regards grüße grüßen saludo saludos saluti cumprimentos""",
    "kin": """mari épouse époux fils fille mère père frère sœur soeur cousin cousine oncle grand-mère grand-père voisin voisine collègue conjoint conjointe compagne
        compagnon husband wife son daughter mother father brother uncle aunt partner neighbour neighbor carer ehemann ehefrau tochter sohn mutter vater bruder
        nachbar nachbarin marido mujer esposa esposo hijo hija madre padre hermano hermana vecina marito moglie figlio figlia fratello sorella filho filha mãe pai
        irmão irmã mulher""",
    "eponym": """maladie maladies syndrome signe signes score échelle test tests sonde classification manœuvre indice index pince critères phénomène anémie tumeur
        lymphome loi méthode technique intervention réflexe point triade coefficient formule équation lame tube appareil prothèse attelle aiguille stade grade
        disease sign scale scores criteria catheter reflex grading stages sarcoma lymphoma tumour method equation formula rule manoeuvre maneuver device needle
        morbus krankheit zeichen skala syndrom prüfung
        enfermedad síndrome signo escala índice prueba criterios maniobra sonda catéter fórmula mal
        malattia morbo sindrome segno scala indice prova criteri manovra catetere formula punteggio
        doença sinal índice teste critérios manobra cateter""",
    "place": """hôpital hôpitaux clinique centre institut université service ville région pays laboratoire pharmacie fondation association société ministère
        hospital clinic center department institute university ward city laboratory pharmacy foundation trust college
        krankenhaus klinik klinikum zentrum universität stadt apotheke abteilung
        clínica centro instituto universidad servicio ciudad farmacia ospedale istituto università reparto città centro farmácia cidade universidade serviço""",
    "street": """rue avenue av ave boulevard boul bd bld chemin allée allées place impasse quai route cours square passage sentier faubourg villa résidence lotissement hameau
        street road lane drive close crescent terrace court st rd dr ln row way gardens grove
        straße strasse str weg gasse platz ring damm ufer chaussee
        calle avenida plaza paseo camino ronda carretera travesía c/
        via viale piazza corso vicolo largo strada piazzale
        rua travessa praça alameda estrada beco""",
    "phone": """tél tel téléphone téléphones telephone phone phones mobile portable portables fax gsm fixe call ring appeler appelez rappeler joindre joignable contacter
        telefon handy rufnummer mobil anrufen teléfono móvil llamar llame telefono cellulare chiamare chiami telefone telemóvel ligar ligue contactar sms whatsapp""",
    "mail": """mail mails e-mail email courriel mél adresse-mail mailto correo posta address contact kontakt contacto contatto contato écrire écrivez write
        schreiben escribir scrivere escrever""",
    "id": """nir insee sécu sécurité sociale assuré assurée immatriculation passeport cni vitale fiscal fiscale siret matricule ssn nhs nino passport insurance
        policy social security tax versichertennummer versicherungsnummer steuer-id steuernummer steueridentifikationsnummer personalausweis reisepass
        sozialversicherungsnummer krankenversichertennummer dni nie nif naf pasaporte afiliación tarjeta sanitaria codice cf tessera passaporto partita utente sns
        niss contribuinte passaporte cidadão identité identity identidad identità identidade""",
    "person": """patient patiente patientin paciente paziente doente pazienta nom prénom name vorname nombre nome apellidos cognome apelido sobrenome signé signature
        signed firmado firma assinado assinatura unterschrift attn attention cc destinataire auteur author médecin médico medico arzt ärztin traitant interne
        chirurgien cardiologue kinésithérapeute psychologue sage-femme surgeon consultant registrar midwife therapist relecteur""",
    "month": """janvier février mars avril mai juin juillet août septembre octobre novembre décembre january february march april may june july august september
        october november december januar februar märz juni juli oktober dezember enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre
        diciembre gennaio febbraio aprile maggio giugno luglio settembre ottobre dicembre janeiro fevereiro março maio junho julho setembro outubro novembro
        dezembro lundi mardi mercredi jeudi vendredi samedi dimanche monday tuesday wednesday thursday friday saturday sunday montag dienstag mittwoch
        donnerstag freitag samstag sonntag lunes martes miércoles jueves viernes""",
    "unit": """mg g kg µg mcg ml l cl dl mmol mmhg cm mm m² ui iu min h j ans an mois jours jour semaines heures years year months days weeks hours jahre jahren tage tagen
        wochen monate años meses días semanas horas anni mesi giorni settimane ore anos dias % °c euros € mmol/l mg/l mg/dl bpm kcal patients patienten
        pacientes pazienti cas cases""",
    "at": "at arobase arobas chez-at chiocciola arroba klammeraffe",
    "dot": "dot point punto punkt ponto",
    "ref": """isbn issn doi pmid n° no nº nr num ref réf référence lot batch charge figure fig tableau table tabelle tabla tabella tabela page pages chapitre article
        essai trial code cotation dossier record item pièce version code-barres ean pubmed nct""",
    "to": """ohne bei zur zum im am in vom beim nach seit über unter durch gegen um bis trotz während selon malgré dès après avant despite during without after before durante tras
        dopo prima sem sin após à a au aux chez in at to for from with by of près vers sous per pour avec par mit von bei für an aus nach con para por su di da del al com em no na ao""",
    "particle": "de du des d' d’ van von der den dos das della dal el le la les ten zu vom",
    "the": """un une l' l’ ce cette ces son sa ses mon ma mes notre votre leur sie ihnen wir ich es man il elle on nous vous ils elles je tu we you they he she it the an this that his her my your our their das die dem ein eine einen einer mein meine ihr
        ihre los las una uno mi tu su lo il gli un' uma os o as meu minha seu sua""",
    "and": "et y e ou and or und oder o ed ni mais but aber pero ma mas que qui who which und",
    "verb": """est a sont ont était avait sera peut doit dit is are was were has had will can must says ist sind war hat kann muss sagt es son era ha puede debe dice
        è sono era può deve é são foi tem pode""",
}

CLASS_OF = {w: name for name, words in reversed(CLASSES.items()) for w in words.split()}
