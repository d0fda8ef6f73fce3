"""The small labelled table from which the recogniser of personal information is trained.

A line is a frame whose places are filled by rule: {N} a person's name (title left out), {T} an optional title, {E} an email address,
{P} a phone number, {I} an identity number, {J} one told by its form, {A} an address, and, unlabelled, {S} a surname in an eponym, {D} a coined capitalised word,
{d} a coined lower-case word, {k} a small number, {z} one of two digits, {U} capitals, {B} and {L} long numbers that identify no person, {O} an organisation or place. Frames and
formats come from general knowledge of letters, forms, mail and clinical prose in six languages, not from any corpus.
"""

from __future__ import annotations

import random

from lexmill.llm.personal_words import GIVEN

KINDS = ("email", "phone", "id_number", "address", "name")
_KNOWN = sorted(GIVEN)
# Forms of address in the six languages.
TITLES = """M.|Mme|Mlle|Monsieur|Madame|Dr|Dr.|Docteur|Pr|Pr.|Professeur|Me|Mr|Mr.|Mrs|Mrs.|Ms|Miss|Prof.|Doctor|Nurse|Herr|Frau|Herrn|Frau Dr.|Herr Prof. Dr.|Prof. Dr.|
Sr.|Sra.|Señor|Señora|Dr. D.|Don|Doña|Dra.|Sig.|Sig.ra|Signor|Signora|Dott.|Dott.ssa|Senhor|Senhora|Sr. Dr.|Dona|Mme le Dr|M. le Pr|le docteur|la docteure|Mme""".replace("\n", "").split("|")

LINES = """
Cher confrère, je vous adresse {T}{N} pour un {d} {d}.
Chère consœur, merci de recevoir {T}{N}, {k} ans, dont l'état reste {d}.
Dear colleague, thank you for seeing {T}{N}, aged {k}, who has {d} {d}.
Sehr geehrte Kollegin, ich überweise Ihnen {T}{N} wegen {d}er {D}.
Estimado colega: le remito a {T}{N}, de {k} años, con {d} {d}.
Gentile collega, Le invio {T}{N}, di {k} anni, per {d} {d}.
Caro colega, envio-lhe {T}{N}, de {k} anos, com {d} {d}.
Nom et prénom : {N}
Nom : {N}
Full name: {N}
Name: {T}{N}
Name des Versicherten: {N}
Nombre y apellidos: {N}
Nome e cognome: {N}
Nome completo: {N}
Médecin traitant : {T}{N}
Chirurgien : {T}{N} ; anesthésiste : {T}{N}
Consultant: {T}{N}. Registrar: {T}{N}.
Behandelnder Arzt: {T}{N}
Médico responsable: {T}{N}
Medico curante: {T}{N}
Médico assistente: {T}{N}
Rédigé par {T}{N} le {k}/{k}/{k}
Dicté par {T}{N}, validé par {T}{N}.
Typed by {N} on {k}/{k}/{k}
Reviewed and approved by {T}{N}
Erstellt von {T}{N}
Redactado por {T}{N}
Redatto da {T}{N}
Elaborado por {T}{N}
Bien confraternellement, {T}{N}
Cordialement, {N}
Kind regards, {N}
Mit freundlichen Grüßen {N}
Un saludo, {N}
Cordiali saluti, {N}
Com os melhores cumprimentos, {N}
{T}{N}, chef de service
{T}{N}, kinésithérapeute
{T}{N}, consultant physician
{T}{N}, Oberarzt
{T}{N}, {k} ans, {d} depuis {k} mois
{T}{N}, née le {k}/{k}/{k}, a été vue par {T}{N}
{T}{N} (né le {k}/{k}/{k})
{T}{N}, geboren am {k}.{k}.{k}
{T}{N}, born {k} May {k}, was reviewed by {T}{N} this morning.
{T}{N}, nacido el {k} de mayo de {k}
{T}{N}, nata il {k} aprile {k}
{T}{N}, nascido a {k} de julho de {k}
{T}{N} a pris rendez-vous pour le {k} juin.
{T}{N} ne s'est pas présentée à la consultation.
{T}{N} was discharged with {d} and {d}.
{T}{N} wurde gestern entlassen.
{T}{N} fue dado de alta ayer.
{T}{N} è stata dimessa ieri.
{T}{N} teve alta ontem.
Nous avons revu {T}{N} en {d}.
J'ai parlé à {T}{N} hier soir.
Avis pris auprès de {T}{N} : {d} {d}.
D'après {T}{N}, la {d} peut attendre.
Le traitement a été expliqué à {T}{N} et à sa fille {N}.
Sa sœur {N} l'accompagne.
Her husband {N} was present.
Ihr Mann {N} war dabei.
Su hermana {N} la acompaña.
Suo figlio {N} era presente.
O filho {N} estava presente.
I spoke to {T}{N} about the {d}.
We met {T}{N} in clinic and discussed {d}.
Ich habe mit {T}{N} gesprochen.
He hablado con {T}{N} sobre el {d}.
Ho parlato con {T}{N} del {d}.
Falei com {T}{N} sobre o {d}.
Prochain rendez-vous avec {T}{N} dans {k} semaines.
Next appointment with {T}{N} in {k} weeks.
Nächster Termin bei {T}{N} in {k} Wochen.
Próxima cita con {T}{N} en {k} semanas.
Prossima visita con {T}{N} tra {k} settimane.
Bonsoir {N}, j'ai eu la même chose l'an dernier.
Coucou {N}, tiens-nous au courant.
Salut, moi c'est {N}, j'ai {k} ans.
je m'appelle {N} et je prends {d} depuis {k} jours
Hi {N}, how is the {d} going?
Hello, my name is {N} and I am {k}.
Hallo {N}, wie geht es dir?
Hola {N}, ¿cómo va el {d}?
Ciao {N}, come stai?
Olá {N}, como está?
Merci {T}{N} !
Merci encore {N}.
Bonjour {T}{N},
Thanks, {T}{N}.
Dear {T}{N},
Danke {T}{N}!
Gracias {T}{N}.
Grazie {T}{N}!
Obrigado {T}{N}.
Chère {T}{N}, cher {N},
Je soussigné {T}{N}, {d}, certifie {d}.
Le rendez-vous de {T}{N} est {d}.
Le dossier de {T}{N} est {d}.
Le mari de {T}{N} et la fille de {T}{N} sont {d}.
Copie à : {T}{N}, {T}{N} et {T}{N}
Copies to {T}{N}, {T}{N}
Kopie an {T}{N}; {T}{N}
Présents : {N}, {N}, {N}
Auteurs : {N}, {N}
Authors: {N}, {N} and {N}
{N} - {P}
{N} | {P} | {E}
{N}, {A}
{N}, {A}, {P}
{N} ; {I} ; {A}
{N};{k};{P};{E}
"{N}","{A}","{P}"
{"patient": "{N}", "phone": "{P}"}
{"email": "{E}", "name": "{N}"}
<td>{N}</td><td>{P}</td>
<p>{T}{N}<br>{A}</p>
Expéditeur : {N} <{E}>
To: {N} <{E}>
Von: {N} <{E}>
Para: {N} ({E})
Ref {L} - {T}{N} - NIR {I}
Patient n° {L} : {T}{N}, sécurité sociale {I}
Assurée : {N}, immatriculation {I}
Numéro INSEE {I}
Sécu : {I}
N° SS {I}
Son numéro de sécurité sociale est le {I}.
Passeport n° {I} délivré à {N}.
CNI {I}
Numéro fiscal : {I}
Identifiant fiscal {I} de {T}{N}
Carte d'assuré social {I}.
NHS no. {I}
National Insurance number: {I}
NI number {I}, {N}
SSN: {I}
Social security number {I} belongs to {T}{N}.
Her passport number is {I}.
Medicare ID {I}
Steueridentifikationsnummer {I}
Krankenversichertennummer: {I}
Die Versicherung führt {T}{N} unter {I}.
Personalausweis {I}
Reisepass Nr. {I}
DNI: {I}
NIE {I}, pasaporte {I}
Número de la Seguridad Social: {I}
Su DNI es {I}.
CF: {I}
C.F. {I}
Il codice fiscale di {T}{N} è {I}.
Tessera sanitaria {I}
Carta d'identità {I}
NIF: {I}
NISS {I}
N.º de utente do SNS: {I}
Cartão de cidadão {I}
O contribuinte {I} é {N}.
{T}{N} demeure {A}.
Domiciliée au {A}, {T}{N} vit seule.
Elle vit {A} avec son frère.
Visite à domicile : {A}
Envoyer les résultats à {T}{N}, {A}.
Mon adresse : {A}
Rendez-vous au cabinet, {A}.
Address: {A}
He lives at {A} with his wife.
Please send the kit to {N}, {A}.
The patient moved to {A} last year.
Anschrift: {A}
Sie wohnt in der {A}.
Adresse: {A}, Telefon {P}
Dirección: {A}
Reside en {A} con su hija.
Indirizzo: {A}
Abita in {A} con il marito.
Endereço: {A}
Mora na {A} com o filho.
Portable : {P}
Tél : {P} / {P}
Fax : {P}
Standard {P}
Secrétariat joignable au {P} de 9 h à 17 h
Merci de téléphoner au {P}
Mon numéro : {P}
Vous pouvez m'appeler au {P} ou m'écrire ({E}).
En cas de fièvre, contacter {T}{N} au {P}.
Mobile: {P}
Tel: {P}, ext. {k}
You can reach the ward on {P}.
If the pain returns ring {P} or email {E}.
Telefon: {P}
Handy {P}
Rückfragen unter {P} an {T}{N}.
Teléfono: {P}
Mi móvil es el {P}.
Cellulare: {P}
Per informazioni telefonare al {P}.
Telemóvel: {P}
Contactar {N} pelo {P}.
mail: {E}
Adresse électronique : {E}
Réponse souhaitée à {E}.
Merci d'envoyer le dossier à {E}
Vos questions sont à adresser à {E}
Son adresse de messagerie est {E}, son portable {P}.
Send the images to {E} please.
You may contact {N} at {E}.
Questions? {E}
Befund bitte an {E} senden.
E-Mail: {E}
Enviar el informe a {E}
Correo electrónico: {E}
Posta elettronica: {E}
Inviare i referti a {E}
Enviar para {E}
Reply to us at {E} or at {P}.
Email the ward at {E}.
Answers welcome at {E}
Le dossier est chez {N} : {E}.
Message de {N}, {E}, reçu le {k}/{k}.
{D} : {P}, {D} : {E}
{D}: {E}; {D}: {P}
[{E}]
({P})
{P}
{E}
{A}
{d} {E} {d}
{d} {d} {E}
{D} {E} {d} {d}
{d}, {E}, {d}
{d} {P} {d}
{d} {d} {P}, {d}
{D} {P} {D}
{d} {d} ({P}) {d}
{d} {d} {J} {d}
{d} {J}, {d} {d}
{D} {D} {J}
{D} {d} : {J}
{T}{N}, {J}
{T}{N}, {P}, {A}
{J}, {N}, {A}
{P} {N} {J}
{d} {A} {d} {d}
{d} {d} {A}, {d}
{d} {d} {T}{N} {d} {d}
{d} {T}{N}, {d} {d}
{T}{N} {d} {d} {d}
{d} {d} {d} {T}{N}
{d} {d} {T}{N} : {d} {d}
""".strip().splitlines()

PLAIN = """
La {d} de {S} reste une cause rare de {d}.
Le {d} évoque une maladie de {S} débutante.
Score de {S} à {k}, échelle de {S} à {k} sur {k}.
Le test de {S} est positif, le signe de {S} absent.
On pose une sonde de {S} puis un drain de {S}.
Une maladie d'{S} a été écartée.
Syndrome de {S}-{S} de type {k}.
Maladies de {S} et de {S} : diagnostic différentiel.
La pince de {S}, l'aiguille de {S} et la table de {S} sont stériles.
La méthode de {S} donne un indice de {k},{k}.
The {S} score was {k} and the {S} scale {k}.
{S}'s disease and {S}'s syndrome were ruled out.
A {S} catheter was inserted; {S} sign negative.
{S}-{S} syndrome is rare.
According to the {S} classification this is grade {k}.
Bekannter Morbus {S}, {S}-Syndrom ausgeschlossen.
Der {S}-Score liegt bei {k}, das {S}-Zeichen ist negativ.
Die {S}sche Krankheit verläuft {d}.
La enfermedad de {S} y el síndrome de {S} son frecuentes.
Escala de {S}: {k}; índice de {S}: {k}.
Il morbo di {S} e la sindrome di {S} vanno esclusi.
Punteggio di {S} pari a {k}; segno di {S} negativo.
A doença de {S} e a síndrome de {S} são raras.
Escala de {S} de {k} pontos, sinal de {S} positivo.
{O}, service de {D}
Le patient a été adressé à {O} pour {d}.
Il a été suivi à {O} puis transféré.
Étude menée à {O} entre {k} et {k}.
The trial was run at {O} from {k} to {k}.
Sie wurde in {O} behandelt.
El ensayo se realizó en {O}.
Ricoverato presso {O}.
Internado em {O}.
Chaque comprimé de {D} {k} mg contient {d} et {d}.
{D} {k} mg : {k} comprimé matin, midi et soir pendant {k} jours.
{D} et {D} ne doivent pas être associés.
Ordonnance : {D} {k} mg, {D} {k} mg, {D} en pommade.
Take {D} {k} mg twice daily with food.
Avoid {D} and {D} during pregnancy.
{D} {k} mg wird zweimal täglich eingenommen.
Tomar {D} {k} mg cada {k} horas.
Assumere {D} {k} mg due volte al giorno.
Tomar {D} {k} mg de {k} em {k} horas.
Le dosage est de {k},{k} g/L et la {d} de {k} mmol/L.
Hémoglobine {k},{k} g/dL ; plaquettes {L} ; leucocytes {L}.
Pression artérielle {k}/{k}, pouls {k}, température {k},{k} °C.
TA : 12/8, 13/7, 14/9 ; FC {k} {k} {k} {k}.
Mesures : {k} {k} {k} {k} {k} {k} {k}
Valeurs successives : {k} {k} {k} {k} {k}.
Blood pressure {k}/{k} mmHg, pulse {k}, weight {k} kg.
Serie: {k} {k} {k} {k} {k} {k}
La dose est passée de {k} à {k} mg le {k}/{k}/{k}.
Le {k} mars {k}, la {d} est revenue.
Du {k} au {k} avril {k}, séjour en {d}.
On {k} March {k} the {d} recurred.
Am {k}. März {k} trat erneut {D} auf.
El {k} de mayo de {k} volvió la {d}.
Il {k} giugno {k} si è ripresentata la {d}.
Em {k} de junho de {k} voltou a {d}.
La {U} est {d}, le {U} et l'{U} restent {d}.
Une {U} et un {U} seront réalisés ; la {U} est à {k}.
À {k} mois, la {U} et la {U} sont {d}.
Dosage de la {U}, de l'{U} et du {U}
The {U} and the {U} were {d}; {U} {k}.
Die {U} und das {U} waren {d}.
La {U} y el {U} son {d}.
La {U} e il {U} sono {d}.
A {U} e o {U} estão {d}.
{U} : {d}. {U} : {d} {d}.
A. Le {d} est {d} B. La {d} est {d} C. Les {d} sont {d} D. Un {d} E. Une {d}
A. La {d} {d}
B. Le {d} {d}
C. L'{d} {d} la {d}
D. Une {d} de {d}
E. Aucune de ces {d}
A. The {d} {d} of the {d}
B. In {d} {d} the {d}
C. An {d} {d}
A. Die {d}e {D} {d}
B. Der {D} {d}
A. El {d} {d} B. La {d} {d} C. Los {d}
A. Il {d} {d} B. La {d} {d} C. Gli {d}
A. O {d} {d} B. A {d} {d} C. Os {d}
a) La {d} ; b) Le {d} ; c) Les {d}
1) La {d} 2) Le {d} 3) Une {d}
Composez le 15 sans attendre ou le 18.
Please dial 999 or go to the nearest {d}.
Dial 911, then 112 from abroad.
Wählen Sie die 112 oder die 110.
Marque el 112 o el 091.
Comporre il 112.
Marque 112 ou 117.
Commande n° {L}{L}, colis {B}
Numéro de série : {L}{L}
Identifiant du document : {B}
Identifiant de publication {B}
Document identifier: {B}
Serial number {B}
Record identifier {L}{L}
Artikelnummer: {B}
Identificador del artículo: {B}
Identificativo articolo: {B}
Identificador do artigo: {B}
Ticket {L}{L} clos
Article : {B}
Code article : {B}
Référence : {B}
Item: {B}
Code : {B} - Lot : {B}
Ref.: {B}
Artículo: {B}
Articolo: {B}
Artigo: {B}
Artikel: {B}
Enregistrement {U}-{L}-{B}
Étude {U}-{L}-{L}, protocole {U}{k}-{L}
Registered as {U}{B} on {k} May {k}
Registrierung {U}-{L}-{L}
EudraCT {k}-{L}-{k}
Intervalle de {k},{k} à {k},{k} pour la {d}
Between {k}.{k} and {k}.{k}; range {k}.{k} to {k}.{k}
{d} {B} {d}
{D} : {B}
{d} {d} : {L}{L}
{D} {d}: {B}
{D} {d} {L}{L} {d}
{d} {d} {L}{k} {d}
Réf. {B}
Bonjour, j'ai {k} ans et une {d} depuis {k} mois.
Bonjour à tous, quelqu'un connaît-il la {d} ?
Bonsoir, merci pour votre réponse.
Merci beaucoup, ma {d} va mieux.
Merci à tous pour les {d}.
Hello everyone, has anyone tried {d}?
Thanks for the {d}, it worked.
Thank you all, my {d} is better.
Hallo zusammen, hat jemand {D} probiert?
Danke für die {D}.
Hola a todos, ¿alguien toma {d}?
Gracias por la {d}.
Ciao a tutti, qualcuno prende {d}?
Grazie per la {d}.
Olá a todos, alguém toma {d}?
Obrigada pela {d}.
During pregnancy the {d} is {d}.
While at work the {d} was {d}.
Lors de la {d}, le {d} est {d}.
Au-delà de {k} jours, la {d} est {d}.
Selon les {d}, le {d} des {d} varie.
Während der {D} ist {D} zu vermeiden.
Nutzen und {D} der {D} sind {d}.
Durante la {d} se evita el {d}.
Durante a {d} deve evitar-se o {d}.
Chez les {d} et chez le {d}, la {d} est {d}.
Dans la {d}, une {d} {d} ou {d} est {d}.
Au cours du {d}, la {d} est restée {d}.
{k},{k}. Au cours de la {d}, le {d} a {d}.
En cours de {d}, la {d} a pris place dans le {d}.
En route vers le {d}, un passage par la {d} suffit.
La {d} tient une place {d} ({k},{k} %). En {k}, le {d} a {d}.
p = 0,0{k}. En {d}, les {d} sont {d}.
p = 0.0{k}. In this {d} the {d} is {d}.
Over the course of {k} days the way of {d} changed.
Im {D} und in der {D} gilt die {D}.
In der {D} ist {D} nicht {d}.
Bei der {D} im {D} wird die {D} {d}.
Unter {D} und mit {D} nimmt die {D} ab.
Trotz {D} und guter {D} bleibt die {D} {d}.
Zur {D} und vor der {D} wird {D} empfohlen.
{d}e {D} {d} die {d}e {D}, mit einem {d}en {D}.
Trotz {d}er {D}, auch bei {d}er {D} oder {D}, ist {D} {d}.
Der {d}e {D} der {D} {d} den {D} und das {D}.
Mit {d}em {D} und {d}en {D} {d} sich die {D}.
Die {d}e {D} hat einen {D} von {D} zu {D}, der {D} entspricht.
Wegen {D} wurde {D} {k} mg im {D} gegeben, danach {D}.
Seit dem {D} im {D} bestehen {D}, {D} und {D}.
Eine {D} ohne {D} braucht keine {D}; jede {D} zählt.
Kein {D}, keine {D}, ein Jahr nach {D} in der {D}.
Auch im {D}, ohne {D}, bei {D}.
Nach dem {D} und zu jeder {D} hilft {D}.
At {d}, the {d} is {d} for {k} days.
In {d} of {d}, on the {d}, by {k}.
During {d} and after {d}, the {d} of {d} is {d}.
With {d}, despite {d}, the {d} is {d}.
Sous {d}, malgré une {d}, la {d} est {d}.
En {d}, par {d}, avec {d}, le {d} est {d}.
Con {d}, en la {d}, a pesar de la {d}.
In {d}, con la {d}, per la {d}, il {d}.
Com {d}, na {d}, apesar da {d}.
FC {k}/min, FR {k}/min, SpO2 {k} %, PA {k}/{k} mmHg, T° {k},{k}
FC {k}/min, TA {k} mmHg, glycémie {k},{k}
HR {k}/min, RR {k}/min, BP {k}/{k}, SpO2 {k}%
PA {k}/{k}, FC {k}/min, Tª {k}
RR {k}/{k}, HF {k}/min, Temp. {k},{k} °C
À J{k}, la {d} est {d}.
- À J{k} : {d} {d}
A J{k} {d} {d}, puis à M{k}
À H{k} et J+{k}, {d} de {k} mg
Day {k}: {d} stable. D{k} {d} removed.
Lésion L{k}-S{k}, stade T{k}N{k}M{k}, IMC {k}, HbA1c {k},{k} %
CRP {k} mg/L, VS {k}, Hb {k},{k}, INR {k},{k}
Tensions : {z} {z} {z} {z} {z} {z}
{z} {z} {z} {z} {z} {z} {z} {z}
{d} : {z} {z} {z} {z} {z} {z} {z} {z}.
Pouls {k} {k} {k} {k}, tension {z} {z} {z} {z}
Glycémies {k} {k} {k} {k} {k}
Nehmen Sie {D} vor der {D} ein.
Bitte informieren Sie Ihren Arzt über {D}.
Mögliche {D} sind {D}, {D} und {D}.
Häufige {D}: {D}, {D}.
Wichtige {D} zur {D} von {D}
Fragen Sie Ihre {D}, wenn die {D} anhält.
Starke {D} können auf eine {D} hinweisen.
l&#39;{d} et d&#39;une {d}
À l&#39;{d} de la {d}, le {d} reste {d}.
L&#39;{d} est {d} &amp; {d}
&lt;b&gt;{D}&lt;/b&gt; : {d}
Caf&eacute; et th&eacute; d&eacute;conseill&eacute;s
Effets Secondaires Possibles
Questions Fréquentes
Points Clés
Key Points
Side Effects
Lot {L}, à utiliser avant {k}/{k}.
Numéro de lot {L}{L}
Batch no. {L}, expires {k}/{k}
N° d'article {L}{k}
Référence {L}-{L}
Dossier n° {L}{L}
Essai NCT0{L}{L}
NCT{L}{L}
ISBN 978-{k}-{L}-{L}-{k}
ISBN 978-2-{L}-{L}-3
ISBN-13 : 978-0-{L}-{L}-7, broché
978-3-{L}-{L}-1
979-1-{L}-{L}-8
(IC 95 % : {k},{k} à {k},{k}) ; intervalle de {k},{k} à {k},{k}
un intervalle de {k} à {k} mois ; {k} régions et {k} villes
ISSN {L}-{L}
doi:10.{L}/{d}.{L}
PMID {L}{L}
EAN {L}{L}{L}
Code {L}, cotation {k}
Brevet EP{L}{L}
Version {k}.{k}.{k} du logiciel {D}
Code CIM-10 : F{k}.{k} ; code ATC A{k}BC{k}
Page {k} sur {k}, tableau {k}, figure {k}
En urgence, faites le 15, le 18 ou le 112.
Appelez le 15 en cas de malaise.
Le 3114 répond jour et nuit.
In an emergency call 999 or 112.
Call 911 at once.
Bei Notfällen 112 oder 116117 anrufen.
Ante una urgencia, llame al 112 o al 061.
In caso di urgenza chiamare il 112 o il 118.
Em caso de urgência ligue 112 ou 808 24 24 24.
Écrire à [EMAIL] ou appeler [TÉLÉPHONE].
{k} mg/mL @ {k} °C
Conserver @ {k} °C pendant {k} min
La rue est bruyante et l'avenue aussi.
Le chemin de {d} comporte {k} étapes.
La place de la {d} dans le traitement du {d} reste à définir.
Voie {d} : {k} à {k} gouttes. Route d'administration : {d}.
Route of administration: oral. Street drugs were denied.
La voie {d}, {k} fois par jour, est préférée.
Le cours dure {k} heures au {k}e étage.
Résidence {d}, chambre {k}, lit {k}
Salle {k}, bâtiment {O}
Conduite à tenir
Antécédents personnels et familiaux
Examens Complémentaires
Résumé Des Caractéristiques Du Produit
CONTRE-INDICATIONS
EFFETS INDÉSIRABLES FRÉQUENTS
Past Medical History
Patient Information Leaflet
Material And Methods
Diagnose Und Therapie
Anamnese: {D} und {D} seit der {D} im {D}.
Die {D} der {D} führt zur {D} bei {D} mit {D}.
Bei {D} ist eine {D} der {D} angezeigt, die {D} bleibt {d}.
Nach {D} und {D} erfolgte die {D} ohne {D}.
Antecedentes Familiares
Efectos Adversos
Anamnesi Patologica Remota
Effetti Indesiderati
Contraindicações Absolutas
L'Organisation mondiale de la Santé recommande la {d}.
La Haute Autorité de Santé a publié un avis.
The World Health Organization and the European Union agreed.
Das Robert-Koch-Institut empfiehlt die {D}.
La Agencia Europea de Medicamentos publicó la ficha.
L'Agenzia Italiana del Farmaco ha pubblicato la nota.
A Direção-Geral da Saúde emitiu uma norma.
La {d} {d} du {d} est {d} chez la femme enceinte, mais {d} chez l'enfant.
Les {d} et les {d} sont plus {d} que les {d} dans cette {d}.
Aucune {d} n'a été observée pendant les {k} mois de {d}.
Une {d} précoce permet de limiter les {d} et d'éviter la {d}.
Après {k} semaines, la {d} diminue et le {d} se stabilise.
Quelle est la {d} la plus probable ?
Laquelle de ces {d} est exacte ?
Vous avez raison, la {d} est {d}.
moi aussi j'ai eu des {d} et ça a duré {k} jours
mon médecin dit que c'est la {d} et ma mère pense le contraire
ma fille a eu la {d} à {k} ans et mon mari aussi
A. {d} {d} B. {d} {d} C. {d}
a) {D} {d} ; b) {D} {d} ; c) {D}
{k}. {D} {d} des {d}
Question {k} : la {d} est-elle {d} ?
Médecin : Bonjour, depuis quand avez-vous cette {d} ?
Patient : Depuis {k} jours, surtout le soir.
Doctor: How long have you had the {d}?
Patient: About {k} days, mostly at night.
Arzt: Seit wann haben Sie die {D}?
Patientin: Seit {k} Tagen, vor allem abends.
The {d} of the {d} was {d} in {k}% of patients.
Results were {d} (p < 0.0{k}; 95% CI {k}.{k}-{k}.{k}).
This {d} may be {d} when the {d} is {d}, particularly in older adults.
However, {d} and {d} remain {d} after {k} months of follow-up.
El {d} de la {d} fue {d} en el {k}% de los casos.
Se recomienda una {d} {d} antes de la {d} para evitar el {d}.
Il {d} della {d} è {d} nel {k}% dei casi.
Si raccomanda una {d} {d} prima della {d} per evitare il {d}.
O {d} da {d} foi {d} em {k}% dos casos.
Recomenda-se uma {d} {d} antes da {d} para evitar o {d}.
Die {d}e {D} sollte bei {d}er {D} vermieden werden.
Es wird empfohlen, die {D} nach {k} Tagen zu prüfen.
Patient de {k} ans, {d} {d}, sous {d} {k} mg.
Patiente de {k} ans, sans {d} notable, hospitalisée pour {d}.
Homme de {k} ans, fumeur, {d} depuis {k} jours.
A {k}-year-old woman with {d} presented with {d}.
Eine {k}-jährige Frau mit {D} stellte sich mit {D} vor.
Mujer de {k} años con {d} y {d}.
Donna di {k} anni con {d} e {d}.
Mulher de {k} anos com {d} e {d}.
Dr {D} est une marque déposée de compléments.
Madame, Monsieur, nous vous remercions de votre {d}.
Docteur, que pensez-vous de la {d} ?
Monsieur, votre {d} est {d}.
Le docteur a prescrit {d} et {d}.
The doctor prescribed {d} and the nurse agreed.
Der Doktor hat {D} verordnet.
El doctor recetó {d}.
Il dottore ha prescritto {d}.
O doutor receitou {d}.
Tout le service remercie l'infirmière et le docteur.
""".strip().splitlines()

_ONSET = "b c d f g l m n p r s t v br ch cl cr dr fl gr pl pr tr h j k qu st z w".split()
_VOWEL = "a e i o u a e i o u ai ou é ei au".split()
_CODA = ["", "", "", "l", "n", "r", "s", "t", "m", "x"]
# Endings of surnames in Europe and beyond.
_FAMILY = "eau ier ard ot in et on ault ière mann berg stein feld ler ner er bach ini etti elli one ari ese ez ero ado illo eira inho ães ado oso son ton ley well ford man ski wicz ov ian oglu ane i y o a".split()
# Endings of coined given names.
_FIRST = "a ia ine ette ie e en in o io us an el ah ane is".split()
_ORG = "Hôpital|Clinique|CHU de|Centre hospitalier de|Institut|Université de|General Hospital|Royal Infirmary|Klinikum|Universitätsklinikum|Hospital de|Clínica|Ospedale di|Policlinico di|Centro de Saúde de|Hospital".split("|")


def _coin(r: random.Random, syllables: int) -> str:
    return "".join(r.choice(_ONSET) + r.choice(_VOWEL) for _ in range(syllables)) + r.choice(_CODA)


def _digits(r: random.Random, shape: str) -> str:
    """The shape with each 0 a digit, 9 a digit but 0, A a capital and a a small letter; what follows a backslash stays."""
    out, i = [], 0
    while i < len(shape):
        c = shape[i]
        if c == "\\":
            i += 1
            c = shape[i]
        elif c == "0":
            c = str(r.randrange(10))
        elif c == "9":
            c = str(r.randrange(1, 10))
        elif c == "A":
            c = r.choice("ABCDEFGHJKLMNPRSTVWXYZ")
        out.append(c)
        i += 1
    return "".join(out)


def surname(r: random.Random) -> str:
    stem = "".join(r.choice(_ONSET) + r.choice(_VOWEL) for _ in range(r.choice([1, 1, 2]))) + r.choice(["l", "n", "r", "m", "s", "d", "t", "rt", "nd", "ch", "g", "v", ""])
    one = (stem + r.choice(_FAMILY)).capitalize()
    u = r.random()
    if u < 0.1:
        return one + "-" + _coin(r, 2).capitalize()
    if u < 0.14:
        return r.choice(["O'", "D'", "Mc", "Le", "Du", "Ben"]) + one
    return one


def given(r: random.Random) -> str:
    """A known given name three times out of five, else a coined one; some are double."""
    one = r.choice(_KNOWN).capitalize() if r.random() < 0.6 else (r.choice([*_ONSET, "", ""]) + r.choice(_VOWEL) + "".join(r.choice(_ONSET) + r.choice(_VOWEL) for _ in range(r.choice([0, 0, 1]))) + r.choice(["", "r", "l", "n"]) + r.choice(["d", "c", "l", "n", "r", "t", "m", "s", "b", "st"]) + r.choice(["", "", *_FIRST])).capitalize()
    if r.random() < 0.12:
        one += "-" + r.choice(_KNOWN).capitalize()
    return one


def name(r: random.Random, titled: bool) -> str:
    first, last = given(r), surname(r)
    part = r.choice(["de ", "de ", "de la ", "du ", "van ", "van der ", "von ", "da ", "dos ", "di ", "del ", "d'", "el ", "le "]) if r.random() < 0.13 else ""
    second = " " + surname(r) if r.random() < 0.1 else ""
    forms = [f"{first} {part}{last}{second}"] * 7 + [f"{last.upper()} {first}"] * 3 + [f"{first} {part}{last.upper()}"] * 2 + [f"{first.upper()} {part.upper()}{last.upper()}", f"{last} {first}", f"{last}, {first}", f"{last}, {first}", f"{last.upper()}, {first}", f"{part}{last}, {first}", f"{part}{last.upper()} {first}", f"{part.upper()}{last.upper()} {first}"]
    initial = first[0] if titled or first[0] != "M" else "J"  # an M before a full stop is a title
    forms += [f"{initial}. {part}{last}"] * (4 if titled else 2) + ([f"{first[0]}.-{given(r)[0]}. {last}", f"{last} {first[0]}."] if r.random() < 0.5 else [])
    if titled:
        forms += [f"{part}{last}"] * 14 + [last.upper()] * 4 + [first] * 2
    else:
        forms += [f"{r.choice(_KNOWN).capitalize()} {part}{last}"] * 3 + [f"{r.choice(_KNOWN)} {part}{last}".lower()] * 3
    return r.choice(forms)


def full_name(r: random.Random) -> str:
    """A given and a family name, told by their form."""
    while True:
        one = name(r, False)
        if one[0].isupper() and " " in one and "." not in one:
            return one


def email(r: random.Random) -> str:
    g, s = r.choice(_KNOWN).lower(), _coin(r, 2)
    user = r.choice([f"{g}.{s}", f"{g}.{s}", f"{g}_{s}", f"{g}-{s}", f"{g[0]}.{s}", f"{g[0]}{s}", f"{g}{r.randrange(1, 99)}", f"{s}{r.randrange(1940, 2005)}", f"{r.choice(['contact', 'info', 'accueil', 'secretariat', 'rdv', 'praxis', 'cabinet'])}.{s}", f"{g}{s}", s, f"{g}.{s}+{_coin(r, 1)}"])
    host = r.choice([_coin(r, 3), f"{_coin(r, 2)}-{_coin(r, 2)}", f"{r.choice(['mail', 'chu', 'med', 'ac'])}.{_coin(r, 2)}", "gmail", "orange", "web", "libero", "example"])
    top = r.choice("fr com org net eu de it es pt co.uk info example test invalid".split())
    at = r.choice(["@"] * 14 + [" @ ", "[at]", " [at] ", "(at)", " (at) ", " at ", " AT ", " arobase ", " [arobase] ", " (arobase) ", " chez ", "<at>", "(a)"])
    dot = "." if at.strip() == "@" or r.random() < 0.4 else r.choice([" dot ", " point ", " (dot) ", "[dot]", " [point] ", " DOT "])
    if at.strip() in ("at", "AT", "chez") and dot == ".":
        dot = r.choice([".", " dot ", " point "])
    out = user + at + host + dot.join(["", *top.split(".")])
    return out.upper() if r.random() < 0.08 else out


def phone(r: random.Random) -> str:
    """A written number: the usual forms of six countries and more, and any other grouping of nine to eleven digits."""
    if r.random() < 0.3:
        left, groups = r.choice([7, 8, 8, 9]), []
        while left > 0:
            groups.append(min(left, r.choice([2, 2, 3, 3, 4, 5, 6])))
            left -= groups[-1]
        sep = r.choice([" ", " ", " ", "-", ".", "/"])
        if groups[-1] == 4 and sep == "-":  # that of other numbers
            sep = " "
        area = r.choice(["\\090", "\\0900", "\\09", "(\\090)", "(\\09)", "+99", "+99 9", "+99-900", "+99 (\\0)90", "\\0\\099", "\\0\\099 900", "900", "(900)"])
        return _digits(r, area + (sep if area[0] != "(" else " ") + sep.join("0" * g for g in groups))
    return _digits(r, r.choice([
        *["\\09 00 00 00 00"] * 5, "\\09.00.00.00.00", "\\09-00-00-00-00", "\\0900000000", "\\0900000000", "\\0900000000", "\\09/00/00/00/00", "(\\09) 00 00 00 00", "+33 9 00 00 00 00", "+33 9 00 00 00 00", "+33 9 00 00 00 00", "\\0\\033 9 00 00 00 00", "+33(\\0)9 00 00 00 00",
        "+33 (\\0)9 00 00 00 00", "+33(\\0)9-00-00-00-00", "+33900000000", "\\0\\033 9 00 00 00 00", "+33.9.00.00.00.00", "+32 000 00 00 00", "+41 00 000 00 00",
        "+44 20 0000 0000", "+44 7000 000000", "\\07000 000000", "\\0200 000 0000", "(900) 000-0000", "900-000-0000", "900.000.0000", "+1 900-000-0000", "+1 (900) 000-0000", "1-900-000-0000",
        "\\030 0000000", "\\030 00000 000", "\\030/0000000", "(\\030) 000000-00", "\\0900 0000000", "\\0900-0000000", "+49 900 0000000", "+49 30 00000 000", "+49 (\\0)30 000000",
        "900 00 00 00", "900 000 000", "900-000-000", "+34 900 000 000", "+34 900 00 00 00", "+34900000000", "\\0\\034 900 000 000", "900000000",
        "300 0000000", "300 000 0000", "+39 300 0000000", "+39 06 0000000", "06 0000000", "\\0\\039 300 000 0000",
        "+351 900 000 000", "+351 20 000 00 00", "200 000 000", "\\0\\0351 900 000 000", "900.000.000", "+351900000000",
    ]))


def social(r: random.Random) -> str:
    """A French social security number in the groupings in use, with or without its key."""
    sep = r.choice([" ", " ", " ", "", "", ".", "-"])
    d = lambda n: "".join(str(r.randrange(10)) for _ in range(n))
    groups = [r.choice("12"), d(2), f"{r.randrange(1, 13):02d}", r.choice([d(2), d(2), "99", "2" + r.choice("AB")]), d(3), d(3)]
    if r.random() < 0.25:
        groups = ["".join(groups[:4]), "".join(groups[4:])] if r.random() < 0.4 else ["".join(groups[:3]), groups[3] + groups[4], groups[5]]
    return sep.join(groups) + r.choice(["", sep, sep, sep, " ", "/", " / ", " clé "]) + d(2)


def distinct(r: random.Random) -> str:
    """An identity number that its form alone gives away."""
    while True:
        one = social(r) if r.random() < 0.6 else identity(r)
        if " " in one or not one.isdigit() or len(one) == 15:
            return one


def identity(r: random.Random) -> str:
    if r.random() < 0.3:
        return social(r)
    return _digits(r, r.choice([
        "00AA00000", "00 AA 00000", "00 00 000 000 000", "0000000000000", "000000000000", "AA0000000", "AAA000000", "A00A00000", "00AAA0000",
        "000 000 0000", "000 000 0000", "AA 00 00 00 A", "AA000000A", "AA-00-00-00-A", "000-00-0000", "000 00 0000", "0AA0-AA0-AA00",
        "00 000 000 000", "00000000000", "A000000000", "A 000 000 000", "00 000000 A 000", "00000000A000", "A00A00A00", "C01A00A00", "L0000AAAA",
        "00000000A", "00000000-A", "00.000.000-A", "00 000 000 A", "A0000000A", "A-0000000-A", "AAA000000", "00 0000000000 00", "00/00000000/00", "28 00000000 00",
        "AAAAAA00A00A000A", "AAA AAA 00A00 A000A", "AA00000AA", "AA0000000", "80000000000000000000",
        "000 000 000", "000000000", "00000000 0 AA0", "00000000 0AA0", "00000000000", "000 000 000 00",
    ]))


def address(r: random.Random) -> str:
    up = lambda n: _coin(r, n).capitalize()
    n = str(r.randrange(1, 250))
    style = r.choice("fr fr fr fr en de es it pt".split())
    code, city = _digits(r, "90000"), r.choice([up(2), up(3), up(2) + "-" + r.choice(["sur", "le", "en", "les"]) + "-" + up(2), "Saint-" + up(2), up(2).upper(), up(1) + " " + up(2)])
    far = r.random() < 0.25
    if style == "fr":
        number = n + r.choice(["", "", "", " bis", " ter", "B", " A"]) + r.choice(["", "", ","])
        kind = r.choice("rue rue rue avenue av. boulevard bd bd. chemin allée place impasse quai route cours square passage Rue Avenue Boulevard Chemin Place RUE".split())
        tail = r.choice([f"de {up(2)}", f"du {up(2)}", f"de la {up(2)}", f"de l'{up(2)}", f"des {up(2)}", f"{up(2)}", f"{up(1)} {up(2)}", f"{r.choice(_KNOWN).capitalize()} {up(2)}", f"{r.choice(_KNOWN).capitalize()}-{up(2)}", f"du {r.randrange(1, 30)} {r.choice(['mai', 'novembre', 'août'])}", f"du Général {up(2)}", f"Saint-{up(2)}", f"des {_coin(r, 2)}s", f"du {_coin(r, 2)}", f"de la {_coin(r, 3)}"])
        end = "" if far else r.choice([f", {code} {city}", f" {code} {city}", f" - {code} {city}", f", {city}", f" à {city}", f", {code} {city} cedex", f", {city} ({code})", f", {code[:2]} {code[2:]} {city}"])
        return f"{number} {kind} {tail}{end}"
    if style == "en":
        kind = r.choice("Street Road Avenue Lane Drive Close Court Crescent Terrace Row Way Gardens St Rd Ave Dr Ln".split())
        post = _digits(r, r.choice(["A0 0AA", "A00 0AA", "AA0 0AA", "AA00 0AA", "A0A 0AA"]))
        end = "" if far else r.choice([f", {city}", f", {city} {post}", f", {city}, {post}", f", {city}, {_digits(r, 'AA 00000')}", f", {post}"])
        return f"{r.choice(['', '', '', f'Flat {n}, '])}{r.randrange(1, 300)}{r.choice(['', '', 'A', 'b'])} {r.choice([up(2), up(2), up(1) + ' ' + up(2), 'St ' + up(2)])} {kind}{end}"
    if style == "de":
        street = r.choice([up(2) + r.choice(["straße", "strasse", "str.", "weg", "gasse", "allee", "platz", "ring", "damm"]), f"{up(2)} {r.choice(['Straße', 'Str.', 'Weg', 'Allee', 'Platz'])}", f"{up(2)}-{up(2)}-{r.choice(['Straße', 'Str.', 'Weg'])}", f"Am {up(2)}", f"An der {up(2)}"])
        return f"{street} {n}{r.choice(['', '', 'a', ' b'])}{'' if far else r.choice([f', {code} {city}', f' {code} {city}', f', D-{code} {city}', f', {city}'])}"
    lower = r.random() < 0.4
    if style == "es":
        kind = r.choice(["Calle", "Calle", "C/", "Avenida", "Avda.", "Plaza", "Paseo", "Camino", "Ronda", "Carrer"])
        tail, extra = r.choice([f"de {up(2)}", f"del {up(2)}", f"de la {up(2)}", f"de los {up(2)}", up(2), f"{up(2)} {up(2)}"]), r.choice(["", "", f", {r.randrange(1, 9)}º {r.choice('ABC')}", f", piso {r.randrange(1, 9)}"])
        end = "" if far else r.choice([f", {code} {city}", f" {code} {city}", f", {city}", f" de {city}"])
    elif style == "it":
        kind = r.choice(["Via", "Via", "Viale", "Piazza", "Corso", "Largo", "Vicolo"])
        tail, extra = r.choice([f"{up(2)}", f"{up(2)} {up(2)}", f"della {up(2)}", f"dei {up(2)}", f"delle {up(2)}", f"San {up(2)}", f"del {up(2)}"]), r.choice(["", "", "", "/A", " interno 4"])
        end = "" if far else r.choice([f", {code} {city}", f" - {code} {city}", f", {city}", f", {code} {city} ({_digits(r, 'AA')})"])
    else:
        kind = r.choice(["Rua", "Rua", "Avenida", "Av.", "Travessa", "Largo", "Praça", "Alameda", "Estrada"])
        tail, extra = r.choice([f"da {up(2)}", f"do {up(2)}", f"das {up(2)}", f"dos {up(2)}", f"de {up(2)}", up(2), f"{up(2)} {up(2)}"]), r.choice(["", "", f", {r.randrange(1, 9)}.º {r.choice(['Dto', 'Esq', 'A'])}"])
        end = "" if far else r.choice([f", {_digits(r, '9000-000')} {city}", f", {city}", f" {_digits(r, '9000-000')} {city}"])
    return f"{kind.lower() if lower else kind} {tail}{r.choice([', ', ', ', ' ', ' nº ' if style != 'it' else ' n. '])}{n}{extra}{end}"


def organisation(r: random.Random) -> str:
    return f"{r.choice(_ORG)} {r.choice(['', '', 'Saint-', 'La ', 'Les '])}{_coin(r, 2).capitalize()}"


def _term(r: random.Random) -> str:
    """A coined capitalised word, as of a drug, a heading or a German noun."""
    return (_coin(r, 2) + r.choice(["", "ine", "ol", "ung", "heit", "tion", "ose", "um", "ite", "keit"])).capitalize()


FILL = {
    "S": surname, "D": _term, "O": organisation,
    "d": lambda r: _coin(r, r.choice([1, 2, 2, 3])) + r.choice(["", "ique", "tion", "ie", "e", "ment", "al", "o", "a"]),
    "U": lambda r: "".join(r.choice("ABCDEGHIKLMNPRSTV") for _ in range(r.choice([2, 3, 3, 3, 4, 5]))),
    "B": lambda r: _digits(r, "9" + "0" * r.randrange(7, 14)),
    "z": lambda r: f"{r.randrange(3, 20):02d}",
    "k": lambda r: str(r.choice([r.randrange(1, 100), r.randrange(1, 20), r.randrange(1930, 2026)])),
    "L": lambda r: _digits(r, r.choice(["9000", "900000", "9000", "90000"])),
}
MAKE = {"E": (email, "email"), "P": (phone, "phone"), "I": (identity, "id_number"), "J": (distinct, "id_number"), "A": (address, "address")}


def fill(line: str, r: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """The sentence and its labelled spans."""
    out, spans, i, titled, size = [], [], 0, False, 0

    def put(text: str, kind: str | None = None) -> None:
        nonlocal size
        if kind:
            spans.append((size, size + len(text), kind))
        out.append(text)
        size += len(text)

    while i < len(line):
        mark = line[i : i + 3]
        c = mark[1:2]
        if len(mark) == 3 and mark[0] == "{" and mark[2] == "}" and (c in "NT" or c in MAKE or c in FILL):
            if c == "T":
                if titled := r.random() < 0.5:
                    put(r.choice(TITLES) + " ")
            elif c == "N":
                put(name(r, titled), "name")
                titled = False
            elif c in MAKE:
                make, kind = MAKE[c]
                put(make(r), kind)
            else:
                put(FILL[c](r))
            i += 3
        else:
            put(line[i])
            i += 1
    return "".join(out), spans


def dropped(r: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """A sentence without personal information with one item put between two of its words, since items come in any context."""
    words = fill(r.choice(PLAIN), r)[0].split(" ")
    at = r.randrange(len(words) + 1)
    mark = r.choice("NNNNNTTEEPPJAA")
    lead, trail = r.choice([("", ""), ("", ""), ("", ""), ("", ","), (": ", ""), ("(", ")"), ("", ".")])
    if mark == "T":
        lead += r.choice(TITLES) + " "
    item, kind = (name(r, True), "name") if mark == "T" else (full_name(r), "name") if mark == "N" else (MAKE[mark][0](r), MAKE[mark][1])
    head = " ".join(words[:at]) + " " * bool(at) + lead
    return head + item + trail + " " * (at < len(words)) + " ".join(words[at:]), [(len(head), len(head) + len(item), kind)]


def _varied(text: str, spans: list, r: random.Random) -> tuple[str, list]:
    """Some lines with typographic apostrophes or without accents, and some of those without labels in capitals, with entities or
    decoded by the wrong table."""
    u = r.random()
    if u < 0.07 and not spans:
        text = text.upper()
    elif u > 0.95 and not spans:
        text = "".join(f"&#{ord(c)};" if c in "'’éèàùêîôç" else c for c in text)
    elif u > 0.9 and not spans:
        text = text.encode().decode("cp1252", "replace")
    elif u < 0.13:
        text = text.replace("'", "’")
    elif u < 0.19:
        text = text.translate(str.maketrans("éèêëàâùûôîïçãõñáíóúüöäÉÈÀ", "eeeeaauuoiicaonaiouuoaEEA"))
    return text, spans


def table(seed: int = 1, each: int = 12, lines: list[str] | None = None, plain: list[str] | None = None) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Filled lines, some joined to one line as they are in running text."""
    r = random.Random(seed)
    rare = lambda x: 2 if any(m in x for m in ("{P}", "{I}", "{J}", "{E}")) else 1  # noqa: E731  kinds of many forms
    single = [_varied(*fill(x, r), r) for x in (LINES if lines is None else lines) for _ in range(each * rare(x))] + [_varied(*fill(x, r), r) for x in (PLAIN if plain is None else plain) for _ in range(each)]
    single += [_varied(*dropped(r), r) for _ in range(len(PLAIN) * each * 2 // 3)] if plain is None else []
    r.shuffle(single)
    rows, i = [], 0
    while i < len(single):
        n = r.choice([1, 1, 2, 3])
        text, spans = r.choice(["", "", "", "", "", "- "]), []
        for t, s in single[i : i + n]:
            text += " " * bool(text and text[-1] != " ")
            spans += [(a + len(text), z + len(text), k) for a, z, k in s]
            text += t
        rows.append((text, spans))
        i += n
    return rows
