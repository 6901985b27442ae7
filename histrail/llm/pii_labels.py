"""A labelled table for the personal-information model, made by a seeded grammar.

A text is put together from general ways to write names, mail addresses, telephone numbers, identity numbers and street
addresses in many countries, set into short notes, fields and JSON in eight languages, beside like-looking text that names
nobody. Most surnames, streets, places and hosts are made of syllables, so that the model learns their shape and not a list.
"""

from __future__ import annotations

import random
import unicodedata
from collections.abc import Iterator

TYPES = {"n": "person_name", "e": "email", "p": "phone", "i": "identity_number", "a": "street_address"}

# Common first names and surnames of many countries.
_FIRST = (
    "James Robert Michael William David Richard Joseph Thomas Susan Jennifer Elizabeth Linda Karen Emily Oliver Harry Amelia Isla Liam Noah Emma Olivia Hannah Leon Felix Jonas Finn Lena Laura Julia "
    "Sabine Ursula Heinz Klaus Jürgen Günter Monika Lucas Hugo Louis Chloé Camille Manon Léa Hélène François Jérôme Gérard Amélie Alejandro Pablo Diego Lucía Martín José Álvaro Elena Rocío Begoña "
    "João Inês Tiago Beatriz Gonçalo Catarina Rui Antônio Luísa Jakub Kacper Antoni Zuzanna Małgorzata Agnieszka Krzysztof Paweł Łukasz Grażyna Ahmet Mustafa Zeynep Elif Hüseyin Şule Ömer Gülşen Çağla "
    "Иван Мария Сергей Анна Ольга Дмитрий Ирина Алексей Dmitri Svetlana Natalia Vladimir Giulia Marco Giovanni Francesca Luca Pieter Sanne Daan Femke Lars Ingrid Sven Freja Søren Åsa Mikko Aino "
    "Nikos Eleni Andrei Ioana Zoltán Katalin Tomáš Jana Ali Hassan Aisha Omar Layla Yusuf Mohammed Amina Raj Anjali Arjun Sunita Wei Ming Hiroshi Sakura Minh Linh Chinedu Ngozi Thabo Zola Sipho Kwaku Abena"
).split()
_LAST = (
    "Smith Johnson Brown Taylor Wilson Davies Evans Walker Wright Hughes Clarke Bennett Müller Schmidt Schneider Fischer Weber Wagner Becker Schäfer Krüger Böhm Martin Bernard Dubois Durand Lefèvre Moreau "
    "Girard García Fernández González López Martínez Sánchez Pérez Núñez Silva Santos Ferreira Oliveira Conceição Kowalski Nowak Wiśniewski Wójcik Kamińska Zieliński Yılmaz Demir Çelik Şahin Öztürk Aydın "
    "Иванов Петрова Сидоров Кузнецова Смирнов Ivanov Petrova Rossi Bianchi Ferrari Jansen Bakker Visser Andersson Nilsson Hansen Sørensen Virtanen Popescu Nagy Novák Dvořáková Papadopoulos Khan Patel Sharma "
    "Singh Gupta Chen Wang Nguyen Tran Tanaka Suzuki Okafor Mensah Dlamini Haddad Hosseini Cohen Levy"
).split()
# Syllables, of which unheard surnames, streets and places are made.
_HEAD = "bar bel ben bol cal cor dan del dor el far fel gal gil har hel il jar kel kem kor lan lor mar mel mor nor or pal pel per quin ral ren rol sal sel tal tar tor ul val var vel wal wil wes zel thal dra grau hal fen ost eis ba be bo bra bre bro ca co cra da de do dra dre fa fe fo fra ga ge gra gre ha he hi ho ja jo ka ke ki ko kra kre la le lo lu ma me mi mo mu na ne no pa pe pi po pra pri ra re ri ro sa se si so sta ste sto ta te ti to tra tre va ve vi vo wa we wi za ze zi kwa sha cha thu dji nya kö mü tö lü grö pé sé ré ço ña łą żu ży şa çe ğu čá ří ål ør".split()
_MID = "la ra na ri no le mi ta de ve lo da sti ran ler men ber del gar tan vin mar len lin dor wen gel bri kal".split()
_TAIL = "n r s l ck m nd rt ld ng ski ska wicz czyk ek ik ák ová ov ova ev in ina enko uk yan dze shvili son sen ssen sson berg stein mann bauer meyer feld hoff thal hardt ström gren quist lund dahl nen lä opoulos idis akis escu eanu ić vić čić oğlu türk can er lı maz etti ini elli ucci ano aro ez az es eira inho ães ard ault eau oux ier in ot el well ton ham field wood ley more ford worth side combe kins gate by wick craft stone bridge burn lock brook penny lett".split()
_PARTICLE = "van de|van der|von|de la|de|del|da|dos|di|al-|el-|O'|Mc|Mac|D'|ben|bin".split("|")
_TITLE = "Mr Mrs Ms Mr. Mrs. Ms. Miss Dr Dr. Prof. Sir Herr Frau Hr. Fr. Dr.-Ing. M. Mme Mlle Monsieur Madame Sr. Sra. Señor Señora D. Dña. Srta. Senhor Senhora Sr Sra Exmo. Pan Pani p. Bay Bayan Sayın Av. Sig. Dott. г-н г-жа Dhr. Mevr. Ing. Mgr.".split()

# Words of business notes, for phrases in capitals that name no person.
_WORDS = (
    "Account Approval Archive Audit Backlog Balance Batch Billing Branch Budget Cancellation Capacity Card Case Central Change Check Claim Clearing Client Closing Collection Compliance Contract Control Corporate Credit Customer Data "
    "Day Decision Delivery Desk Device Dispatch Document Duty Early Energy Engine Escalation Event Export External Field Final Finance Fraud Gate General Group Handover Help Import Incident Inspection Insurance Intake Internal Invoice "
    "Item Ledger Legal Letter Level Limit Line Loan Local Mail Main Maintenance Manual Market Master Meter Monthly Network New Night Notice Office Old Onboarding Open Operations Order Origination Outbound Parcel Partner Payment Payroll Pending Plan "
    "Policy Portal Price Product Project Quality Quarter Queue Rate Record Refund Region Registry Relay Release Renewal Repair Report Request Reserve Return Review Risk Route Rule Sales Schedule Screening Second Section Security Service Session Settlement "
    "Shared Shift Signal Special Staff Standard Status Step Stock Store Supplier Support System Task Tax Team Terminal Ticket Timer Trade Transfer Treasury Unit Update Vendor Waiting Warehouse Weekly Window Work Zone"
).split()

# What stands before a piece of personal information, by language and type, and what may stand after it. Nothing of it tells
# that a piece follows: all of it is also used with phrases and references in its place.
_BEFORE = {
    "n": (
        "customer|the client|spoke to|talked with|assigned to|approved by|rejected by|reported by|on behalf of|requested by|contact person|account holder|our colleague|letter from|please ask|case worker:|name:|beneficiary|payee|signatory|handed to|claimant|patient|tenant|witness|agent|user|sent by|for the attention of|visit of|complaint from|recipient|consignee|sender|applicant|driver|buyer|seller|guarantor|spouse|heir|employee|director|nurse|student|insured|debtor|guest|courier for|returned by|collected by|request of|wish of|demande de|petición de|prośbę|isteği:|"
        "Herr Kollege|Kundin|Ansprechpartner|Bearbeiter:|gemeldet von|Rücksprache mit|im Auftrag von|Antragsteller|Vertragspartner|genehmigt durch|Zahlung an|client|demandé par|dossier de|signé par|réclamation de|validé par|titulaire :|interlocuteur|au nom de|avocat|"
        "cliente|solicitado por|firmado por|en nombre de|titular:|hablé con|llamó|responsable:|a petición de|pedido por|assinado por|em nome de|falei com|utente|a pedido de|klient|zgłoszone przez|podpisał|w imieniu|rozmowa z|na wniosek|opiekun:|müşteri|onaylayan|talep eden|ile görüşüldü:|adına|imza:|клиент|по просьбе|подписал|заявитель|от имени|звонил"
    ).split("|"),
    "e": (
        "write to|reply to|email|e-mail:|mail to|sent from|forwarded to|contact|cc|mailbox|address|answer goes to|please notify|confirmation sent to|bounced:|E-Mail an|Antwort an|geschickt an|Adresse|erreichbar unter|envoyé à|répondre à|courriel :|adresse|correo|escribir a|enviado a|copia para|correio|responder para|enviado para|wysłano na|adres|kontakt|e-posta|gönderildi:|yanıt adresi|почта|написать на|ответ на"
    ).split("|"),
    "p": (
        "call|phone|phone number|tel.|mobile|ring|dial|reach on|number|text message to|voicemail from|hotline|contact number:|fax|cell|Telefon|Tel.:|Rückruf|anrufen|Handy|mobil|Nummer|tél.|appeler le|téléphone|portable|numéro|rappeler au|teléfono|llamar al|móvil|número|telefone|telemóvel|ligar para|telefon|zadzwonić|numer|kom.|tel|telefonu|cep|ara|numara|телефон|звонить|моб.|номер"
    ).split("|"),
    "i": (
        "SSN|social security number|tax number|tax id|national id|ID no.|passport|passport no.|NI number|NINO|ID card|insurance number|identity document|personal number|Steuer-ID|Steuernummer|Steuer-IdNr.|Ausweis|Ausweisnummer|Personalausweis|Reisepass|Reisepass Nr.|numéro de sécurité sociale|NIR|carte d'identité|passeport|passeport n°|DNI|NIF|NIE|pasaporte|documento|NIF nº|CPF|contribuinte|cartão de cidadão|PESEL|nr PESEL|dowód|paszport|dowód osobisty|NIP|TCKN|TC kimlik no|TC Kimlik|T.C. kimlik no|kimlik|pasaport no|vergi no|СНИЛС|ИНН|паспорт|BSN|codice fiscale|Aadhaar|PAN|document number|identification"
    ).split("|"),
    "a": (
        "address|new address|lives at|deliver to|delivery address:|moved to|resident at|mail to|send to|billing address|shipped to|returned from|located at|property at|visit at|Anschrift|wohnhaft|Adresse:|Lieferung an|zugestellt|umgezogen nach|Wohnung|adresse|domicilié|livré au|habite|déménagé au|dirección|domicilio|vive en|entregar en|enviado a|morada|residente em|entregar na|endereço|adres|zamieszkały|dostawa:|przeprowadzka na|adresi|teslimat|ikamet|taşındı:|адрес|доставка|проживает"
    ).split("|"),
}
_AFTER = (
    "||||today|yesterday|this morning|again|twice|and confirmed|about the case|before the deadline|for review|after lunch|will be back|please|was informed|did not answer|as agreed|, see file|, urgent|(verified)|, checked|has signed|wants a refund|has called|withdrew the request|asks for a copy|no reply yet|heute|erneut|bitte prüfen|wurde informiert|ist bestätigt|hat widersprochen|meldet sich|aujourd'hui|sans réponse|"
    "last month|last week|next year|in May|since Monday|by post|in person|on site|without reason|for good|, not paid|, moved|a confirmé|demande un délai|hoy|otra vez|confirmado|sin respuesta|pide una copia|hoje|de novo|sem resposta|confirmou|dzisiaj|potwierdzono|bez odpowiedzi|prosi o kontakt|bugün|tekrar|onaylandı|bekliyor|сегодня|подтверждено|без ответа"
).split("|")
_KEYS = {
    "n": "name customer client contact contactPerson applicant holder assignee approver caller requester fullName displayName clientName customerName contactName responsible signer payee beneficiary employee kunde nom nombre nome ad insured agent user reviewer".split(),
    "e": "email mail e_mail contactMail userEmail replyTo sender recipient from to cc notify emailAddress correo courriel".split(),
    "p": "phone tel mobile telephone phoneNumber contactPhone cell telefon tel_no callback fax msisdn whatsapp home work".split(),
    "i": "ssn taxId nationalId passport idCard passportNo personalNumber idDocument document identity nif dni pesel tckn nino steuerId cpf documentId identifier".split(),
    "a": "address street deliveryAddress homeAddress shipTo billing addressLine residence location site adresse direccion morada postal".split(),
}
_OTHER_KEYS = "status step state amount count retries ref reference orderId caseId batch node channel source type priority version duration result score code region currency flag hash worker queue topic attempt rule key total limit date due created".split()
# What people do, and how they are mentioned in the middle of a note. ``{n}`` is somebody, or a phrase that is nobody.
_DEEDS = (
    "{n} wants to cancel|{n} asked for a copy of {r}|{n} called about {r}|{n} paid {m}|{n} has left the company|{n} will sign on {D}|{n} and {n} agreed|{n} forwarded it to {n}|sent by {n} to {n}|inherited from {n} by {n}|waiting for {n} to answer|told {n} that {w} is closed|met {n} at the {w}|as {n} wrote on {D}|refund for {n} of {m}|{n} refused the {w}|"
    "give it to {n} or {n}|ask {n} on the phone|informed {n} by mail|{n} is ill|between {n} and {n}|{n} closed {r}|according to {n} it was paid|{n} did it|owner {n}|from {n}|by {n}|to {n}|with {n}|cc {n}|{n} requested a stop|the file of {n}|{n} moved|{n} signed for the parcel|parcel for {n}|receiver {n}|subscriber {n}|policy holder {n} has died|visit by {n} on {D}|checked by {n} at {t}|"
    "{n} hat gekündigt|{n} möchte zurücktreten|Anruf von {n} am {D}|{n} bittet um Antwort|Schreiben an {n}|mit {n} besprochen|{n} hat bezahlt|Empfängerin {n}|{n} a appelé|{n} demande un remboursement|vu avec {n} le {D}|appeler {n} au|envoyé à {n}|selon {n}, payé|{n} souhaite annuler|destinataire {n}|{n} quiere anular|llamada de {n}|avisar a {n} por|según {n}|{n} ha pagado|"
    "hablado con {n} por|enviado a {n}|{n} quer cancelar|ligação de {n}|avisar {n}|{n} pagou|enviado a {n}|{n} chce anulować|telefon od {n}|wysłano do {n}|{n} zapłacił|według {n}|{n} iptal istedi|{n} aradı|{n} ile konuşuldu|{n} ödedi|{n} için iade|başvuran {n}|{n} просит отменить|звонок от {n}|отправлено {n}|{n} оплатил"
).split("|")
# Things that have a number and are no address.
_UNITS = (
    "department room floor lane row shelf gate desk line team group level stage step module section box hall wing bay dock page queue shard node slot zone track platform seat Abteilung Zimmer Etage Raum Gruppe Stufe Modul Platz Zeile Spalte Team Halle Schalter Stelle Referat bureau salle étage quai ligne niveau service colonne "
    "planta sala puerta fila nivel mesa departamento andar linha setor porta piętro pokój dział linia poziom brama wydział kat oda bölüm sıra birim kapı этаж отдел комната линия уровень зал"
).split()
_CODES = "Vorgang Fall Akte Konto Kunde Vertrag Position Bestellung Los Lauf dossier compte contrat expediente cuenta contrato processo conta sprawa konto umowa işlem dosya hesap token code voucher licence key lot article SKU ticket batch serial invoice tracking pin coupon case order Auftrag Beleg Rechnung jeton facture commande código factura pedido kod faktura zamówienie fiş sipariş код заказ session lock trace build hash part".split()
# What has happened, without anybody in it.
_PLAIN = (
    "the {w} has been closed|{w} was moved to {W}|{W} waits for {w}|{w} {r} is open|reference {r} not found|see {r}|order {r} shipped|retry {k} of {k} failed|took {m} ms|amount {m} EUR|total of {m}|{W}|{W} {k}|{w}|duplicate of {r}|node {u} restarted|checksum {u}|version {v} deployed|ran at {t}|due {D}|since {D}|{m} rows written|no {w} given|{w} missing|closed by {W}|handed over to {W}|assigned to {W}|"
    "sent to {W}|approved by the {w} team|rejected by {W} ({r})|limit {m} exceeded|host {x} down|timer {k}:{k} fired|from {x} to {x}|batch {r} of {D}|{W} skipped|phone line busy|no phone on file|mail queue is full|mail template {k} missing|empty address|address check passed|passport control done|id check pending|name field empty|call failed with code {k}|tax table {v} loaded|parcel {l} scanned|tracking {l}|"
    "Vorgang {r} abgeschlossen|{W} an {W} übergeben|Betrag {m} gebucht|Adresse fehlt|Telefon unbekannt|keine Antwort von {W}|Zeile {k} gelöscht|Lauf vom {D}|dossier {r} clos|montant {m}|ligne {k} supprimée|adresse manquante|étape {W} terminée|expediente {r} cerrado|importe {m}|falta la dirección|paso {W} listo|processo {r} fechado|valor {m}|morada em falta|sprawa {r} zamknięta|kwota {m}|brak adresu|krok {W} gotowy|"
    "işlem {r} kapandı|tutar {m}|adres yok|{W} adımı bitti|заявка {r} закрыта|сумма {m}|адрес не указан|этап {W} завершён|true|false|null|none|n/a|-|{k}|{m}|{r}|{u}|{l}|{D}|{t}|ok|done|cancelled|obsolete|{x}|room {k}|lane {k}|desk {k}, floor {k}|gate {k}|street lights off|road closed at km {k}|page {k} of {k}|IBAN {b}|card {c}|account {l}|serial {r}-{k}|ratio {k}:{k}|{k}-{k} items|weeks {k}-{k}|position {m}, {m}|{U}|{U}|moved to {U}|{U} is full|an {U}|aus {U}|von {U} nach {U}|vers {U}|a {U}|do {U}|{g}|{g}|{g} expired|{g} is invalid|{g} ungültig|{g} used twice|new {g}|{g} -> {g}|took {k} s|after {k} min|in {k} s|{k} ms late|terminé en {k} s|nach {k} s|{k} dakika|{k} min|service à {k} h|before {k} pm|every {k} h|{W} reported nothing|{W} took over from {W}|signed by {W}|{k} {W} items are late|{W} at {t}|{W} of {D}|copy for {W}|wait for {W}"
).split("|")


# Words of eight languages that stand in any note.
_COMMON = (
    "kayıt silindi|süre doldu|dosya eksik|belge bekleniyor|ödeme yapılmadı|alan dolu değil|bilgi alınamadı|form gönderildi|kayıt bulunamadı|yeniden denenecek|tarih geçersiz|boş bırakıldı|sisteme girildi|kontrol edildi|le service ne répond pas|délai dépassé|pièce manquante|champ vide|compte bloqué|rien à signaler|voir le service|en attente de réponse|motif inconnu|adresse inconnue|erreur de saisie|"
    "Grund nicht angegeben|Frist abgelaufen|Feld ist leer|Vorgang gesperrt|Unterlagen fehlen|kein Rückruf nötig|wurde storniert|Grund offen|Ausweis abgelaufen|Karte gesperrt|Rechnung bezahlt|Anfrage erledigt|Vertrag gekündigt, Frist läuft|Ware geliefert|Betrag erstattet|Kunde nicht erreicht|Adresse geprüft|Unterschrift fehlt|Antrag abgelehnt|Termin verschoben|Nummer falsch|Steuer bezahlt|Konto geschlossen|Prüfung entfällt|bitte warten|motivo desconocido|plazo vencido|campo vacío|falta un documento|sin cambios|cuenta cerrada|se espera respuesta|dato no facilitado|prazo expirado|campo vazio|documento em falta|conta fechada|sem alteração|aguarda resposta|termin minął|pole puste|brak dokumentu|konto zamknięte|bez zmian|czeka na odpowiedź|numer nie podany|"
    "срок истёк|поле пустое|нет документа|счёт закрыт|без изменений|ждём ответа|причина неизвестна|field left empty|reason unknown|nothing to report|was not supplied|no change|waiting for an answer|given up|not found in the register|deleted by mistake|number withheld|rolled back|value was blank|stopped by hand|no call needed|gave no result|document not readable|check was skipped|window is open|ended early"
).split("|")


class Filler:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def d(self, n: int) -> str:
        return "".join(self.r.choices("0123456789", k=n))

    def caps(self, n: int) -> str:
        return "".join(self.r.choices("ABCDEFGHJKLMNPQRSTUVWXYZ", k=n))

    def mask(self, mask: str) -> str:
        """9 a digit, 8 a digit but 0, A a capital; the rest stands as it is."""
        return "".join(self.d(1) if c == "9" else self.r.choice("123456789") if c == "8" else self.caps(1) if c == "A" else c for c in mask)

    def made(self) -> str:
        """A name that nobody has heard."""
        r = self.r
        word = r.choice(_HEAD) + (r.choice(_MID) if r.random() < 0.45 else "") + r.choice(_TAIL)
        return word[0].upper() + word[1:]

    def last(self) -> str:
        r = self.r
        one = r.choice(_LAST) if r.random() < 0.25 else self.made()
        x = r.random()
        if x < 0.06:
            p = r.choice(_PARTICLE)
            return f"{p}{one}" if p[-1] in "-'c" else f"{p} {one}"
        if x < 0.15:
            return f"{one}-{r.choice(_LAST) if r.random() < 0.3 else self.made()}"
        return f"{one} {self.made()}" if x < 0.17 else one

    def first(self) -> str:
        r = self.r
        one = r.choice(_FIRST) if r.random() < 0.8 else self.made()
        return f"{one}-{r.choice(_FIRST)}" if r.random() < 0.06 else one

    def n(self) -> str:
        r, first, last = self.r, self.first(), self.last()
        x = r.random()
        if x < 0.38:
            name = f"{first} {last}"
        elif x < 0.50:
            name = f"{first[0]}. {last}"
        elif x < 0.54:
            name = f"{first[0]}.{r.choice(('', ' '))}{r.choice(_FIRST)[0]}. {last}"
        elif x < 0.66:
            name = f"{last}, {first}" if r.random() < 0.8 else f"{last}, {first[0]}."
        elif x < 0.74:
            name = f"{first} {self.caps(1)}. {last}"
        elif x < 0.78:
            name = f"{first} {r.choice(_FIRST)} {last}"
        elif x < 0.90:
            name = f"{r.choice(_TITLE)} {last}"
        elif x < 0.97:
            name = f"{r.choice(_TITLE)} {first} {last}" if r.random() < 0.7 else f"{r.choice(_TITLE)} {first[0]}. {last}"
        else:
            name = f"{first} {r.choice(('Bey', 'Hanım'))}" if r.random() < 0.5 else f"{last} {first}"
        y = r.random()
        return name.upper() if y < 0.07 else name.lower() if y < 0.12 else f"{last.upper()}, {first}" if y < 0.16 else f"{first} {last.upper()}" if y < 0.19 else name

    def _ascii(self, word: str) -> str:
        plain = unicodedata.normalize("NFKD", word.translate(str.maketrans("łŁıøØßđ", "lLioOsd"))).encode("ascii", "ignore").decode().lower()
        return "".join(c for c in plain if c.isalnum()) or "user"

    def host(self) -> str:
        r = self.r
        name = self._ascii(self.made()) if r.random() < 0.7 else self._ascii(r.choice(_WORDS))
        name = name if r.random() < 0.7 else f"{name}{r.choice('-.')}{self._ascii(r.choice((self.made(), r.choice(_WORDS))))}"
        return f"{name}.{r.choice('com org net de fr es pt pl ru it nl eu io co.uk com.tr com.br example test invalid example.com example.org'.split())}"

    def e(self) -> str:
        r = self.r
        a, b, role = self._ascii(self.first()), self._ascii(self.last()), self._ascii(r.choice(_WORDS))
        local = r.choice((f"{a}.{b}", f"{a}{b}", f"{a[0]}.{b}", f"{a[0]}{b}", f"{b}.{a}", f"{a}_{b}", f"{b}{self.d(2)}", f"{a}-{b}", f"{a}", f"{b}_{a[0]}", f"{a}.{b}+{role}", role, f"{role}-{self._ascii(r.choice(_WORDS))}", f"{role}.{self._ascii(r.choice(_WORDS))}", f"{role}_{self._ascii(r.choice(_WORDS))}", f"{role}+{self._ascii(r.choice(_WORDS))}", r.choice(("info", "no-reply", "noreply", "support", "contact", "office", "admin", "hello", "service"))))
        host = self.host()
        x = r.random()
        if x < 0.16:
            at = r.choice((" (at) ", " [at] ", "(at)", "[at]", " at ", " AT ", " {at} "))
            dot = r.choice((".", ".", " [dot] ", " (dot) ", " dot ", "[dot]", "(dot)"))
            if at.strip().isalpha():
                dot = " dot "
            local = local if r.random() < 0.5 else local.replace(".", dot)
            return f"{local}{at}{host.replace('.', dot)}"
        mail = f"{local}@{host}"
        if x < 0.26:
            mail = mail.upper() if r.random() < 0.6 else mail.title()
        y = r.random()
        return f"<{mail}>" if y < 0.1 else f"mailto:{mail}" if y < 0.2 else mail

    def p(self) -> str:
        """Country and area code, then groups of digits, with one sort of sign between them."""
        r = self.r
        sep = r.choice((" ", " ", " ", "-", "-", ".", "/", ""))
        groups = r.choice(("3 3 4", "3 4", "4 4", "2 3 2 2", "2 2 2 2", "4 3", "5 3", "3 2 2", "3 3 3", "4 4 4", "4 6", "3 6", "7", "8", "4 3 3", "3 3", "5 6", "4 5", "6", "4 2 2"))
        tail = sep.join(self.d(int(g)) for g in groups.split())
        code = r.choice("1 7 20 27 31 32 33 34 39 40 41 43 44 45 46 47 48 49 51 52 54 55 61 62 81 82 86 90 91 351 352 353 358 380 420 971".split())
        area = r.choice((self.mask("89"), self.mask("899"), self.mask("899"), self.mask("8999"), self.mask("8")))
        j = sep if r.random() < 0.7 else " "
        x = r.random()
        if x < 0.30:
            out = f"+{code}{j}{area}{j}{tail}"
        elif x < 0.36:
            out = f"+{code}{r.choice((' ', ''))}({r.choice(('0', area))}){r.choice((' ', ''))}{area}{j}{tail}"
        elif x < 0.44:
            out = f"00{code}{j}{area}{j}{tail}"
        elif x < 0.54:
            out = f"({self.mask('899')}){r.choice((' ', '', '-'))}{self.mask('999')}{r.choice('- .')}{self.d(4)}"
        elif x < 0.62:
            out = self.mask("899") + sep + self.mask("999") + sep + self.d(4) if sep else self.mask("8999999999")
        elif x < 0.70:
            out = f"+1{r.choice(('-', ' ', '.', ''))}{self.mask('899')}{r.choice(('-', ' ', '.'))}{self.mask('999')}{r.choice(('-', ' ', '.'))}{self.d(4)}" if r.random() < 0.7 else f"+{code}{self.d(r.choice((8, 9, 10)))}"
        elif x < 0.88:
            out = f"0{area}{r.choice((j, ' ', '/', '-'))}{tail}" if r.random() < 0.6 else " ".join(["0" + self.mask("8"), *[self.d(2) for _ in range(4)]]) if r.random() < 0.5 else f"0{self.mask('8999')} {self.mask(r.choice(('999999', '999 999', '999 9999')))}"
        elif x < 0.93:
            out = self.mask(r.choice(("899 999 999", "89 999 99 99", "899 99 99 99", "8999 9999", "899-999-999", "899.999.999")))
        else:
            out = f"tel:+{code}{self.d(r.choice((8, 9, 10)))}"
        if r.random() < 0.25:  # the usual forms of some countries
            out = self.mask(r.choice(("029 9999 9999", "0899 999 9999", "08999 999999", "07999 999999", "08 99 99 99 99", "08.99.99.99.99", "0899 9999999", "089 99999 999", "089 9999999", "0899/999999", "0499 999 999", "0599 999 99 99", "699 999 999", "899 999 999", "+48 999 999 999", "+34 699 999 999", "+33 8 99 99 99 99", "+90 599 999 99 99", "+44 29 9999 9999", "+44 7999 999999", "+49 (0)89 99999-999", "+49 899 9999999", "+351 999 999 999", "+7 999 999-99-99", "8 (999) 999-99-99", "+39 399 999 9999", "(89) 9999-9999", "0044 7999 999999", "+61 499 999 999", "tel:+499999999999", "tel:+19999999999", "+19999999999", "+1-899-999-9999")))
        digits = sum(c.isdigit() for c in out)
        if digits > 15 or digits < 7:
            return self.p()
        return out + (f" {r.choice(('ext.', 'ext', 'x', 'app.'))} {self.d(r.choice((2, 3, 4)))}" if r.random() < 0.03 else "")

    #: Forms of identity numbers that show what they are, and for each sort of number its names and forms.
    CLEAR = ("899-99-9999", "899 99 9999", "999-99-9999", "AA999999A", "AA 99 99 99 A", "99999999A", "99999999-A", "X9999999A", "999.999.999-99", "AAAAAA99A99A999A", "AAAAA9999A", "8 99 99 99 999 999 99", "999-999-999 99")
    SORTS = (
        ("SSN|social security number|Social Security no.|ssn|soc. sec.", "899-99-9999|899 99 9999|999-99-9999|999999999"), ("NI number|NINO|national insurance number|NI no.|Nino", "AA999999A|AA 99 99 99 A|AA 999999 A"),
        ("tax number|tax id|TIN|tax ID no.|ITIN", "99-9999999|999999999|9999999999|899-99-9999|99 999 999 999"), ("passport|passport no.|passport number|Passport No|pass no|travel document", "A9999999|999999999|AA9999999|A99999999|99AA99999|AA 999999|A99A99A99"),
        ("national id|ID no.|ID card|identity document|id number|identity number|personal number|identity card|ID", "AA9999999|999999999|A99999999|99999999A|999999-9999|AAA999999|99999999999"), ("Steuer-ID|Steuer-IdNr.|Steuer-Identifikationsnummer|Steuernummer|IdNr.|Steuer-Id Nr.", "99 999 999 999|99999999999|99/999/99999"),
        ("Ausweis|Ausweisnummer|Personalausweis|Ausweis-Nr.|Perso", "A99A99A99|999999999|AA99A99A9|A99999999"), ("Reisepass|Reisepass Nr.|Reisepassnummer|Pass-Nr.", "A99A99A99|A99999999|A9999999|AA9999999"), ("numéro de sécurité sociale|NIR|n° de sécu|sécurité sociale", "8 99 99 99 999 999 99|8999999999999|899999999999999"),
        ("carte d'identité|passeport|passeport n°|CNI|pièce d'identité", "99AA99999|999999999999|99AA999999|A9999999"), ("DNI|NIF|NIE|DNI nº|NIF nº|documento|D.N.I.", "99999999A|99999999-A|X9999999A|X-9999999-A|99.999.999-A|99999999 A"), ("pasaporte|pasaporte nº|passaporte|passaporte n.º", "AAA999999|AA999999|A9999999"),
        ("CPF|contribuinte|NIF|cartão de cidadão|CPF nº", "999.999.999-99|999999999|999 999 999|99999999999|99999999 9 AA9"), ("PESEL|nr PESEL|PESEL nr|numer PESEL|pesel", "99999999999|99999999999|999999 99999"), ("dowód|dowód osobisty|paszport|nr dowodu|nr paszportu", "AAA999999|AAA 999999|AA9999999"),
        ("TCKN|TC kimlik no|TC Kimlik|T.C. kimlik no|kimlik no|T.C. No|TC no|kimlik", "99999999999|99999999999|999 999 999 99"), ("vergi no|vergi kimlik no|pasaport no|pasaport", "9999999999|A99999999|A9999999"), ("СНИЛС|ИНН|паспорт|номер паспорта", "999-999-999 99|999999999999|99 99 999999|9999 999999"),
        ("BSN|rijksregisternummer|codice fiscale|C.F.|personnummer|henkilötunnus|rodné číslo|CNP|OIB", "999999999|AAAAAA99A99A999A|999999-9999|99.99.99-999.99|999999/9999|8999999999999|99999999999"), ("Aadhaar|Aadhaar no|PAN|SIN|ID kenteken|NRIC", "9999 9999 9999|AAAAA9999A|999 999 999|A9999999A"),
    )

    def sort(self) -> tuple[str, str]:
        names, masks = self.r.choice(self.SORTS)
        label = self.r.choice(names.split("|"))
        number = self.mask(self.r.choice(masks.split("|")))
        if self.r.random() < 0.2:  # written with other signs between the groups
            number = "".join(self.r.choice(" -") if c in " -" else c for c in number)
        return label + self.r.choice((" ", " ", " ", ": ", "=", " no. ", " : ")), number

    def a(self) -> str:
        r, made = self.r, self.made
        no = str(r.choice((r.randint(1, 30), r.randint(1, 250), r.randint(1, 2500)))) + (r.choice("aAbBcC") if r.random() < 0.14 else "") + (f"-{r.randint(2, 90)}" if r.random() < 0.03 else "")
        town = r.choice((made(), made(), f"{made()} {made()}", r.choice("London Berlin Paris Madrid Lisboa Warszawa İzmir Москва Boston Köln Lyon Porto Gdańsk".split())))
        tree = r.choice("Oak Maple Elm Cedar Birch Rose Church Park Mill High Station King Queen Victoria North South Hill Lake River Garden Forest Green Bridge School Castle".split())
        english = f"{r.choice((tree, tree, made(), made() + ' ' + made(), tree + r.choice('wood field side view land ton bury well crest'.split())))} {r.choice('Street Street St St. Road Road Rd Rd. Lane Ln Avenue Ave Ave. Drive Dr Way Close Court Ct Crescent Terrace Square Place Boulevard Blvd Grove Hill Walk Row Gardens Parkway Mews Hollow Rise Quay'.split())}"
        german = r.choice((f"{made()}{r.choice('straße strasse str. weg gasse allee platz ring damm ufer steig hof'.split())}", f"{r.choice('Linden Garten Bahnhof Schul Kirch Haupt Berg Wald Rosen Mühlen Birken Kastanien Ziegel Gerber Markt Brunnen'.split())}{r.choice('straße str. weg gasse allee platz'.split())}", f"{r.choice('Am Im An der Zum Zur Auf dem Alte Neue Lange'.split())} {r.choice((made(), 'Markt', 'Bach', 'Hang', 'Anger', 'Gasse', 'Steinweg', 'Tor'))}", f"{made()}er {r.choice('Straße Weg Platz Allee Str.'.split())}"))
        link = r.choice(("de la ", "du ", "des ", "de ", "de l'", "", ""))
        french = f"{r.choice('rue Rue avenue av. boulevard bd place allée impasse chemin quai route cours passage'.split())} {link}{r.choice((made(), made() + '-' + made(), r.choice('Paix Gare Moulin Lilas République Tilleuls Écoles Liberté Forge Fontaine Église'.split())))}"
        spanish = f"{r.choice('Calle calle C/ Avda. Avenida Av. Plaza Paseo Pza. Camino Ronda Travesía'.split())} {r.choice(('de la ', 'del ', 'de ', 'de los ', '', ''))}{r.choice((made(), r.choice('Mayor Real Sol Luna Iglesia Fuente Olivar Estación Noria Constitución Ribera'.split())))}"
        portuguese = f"{r.choice('Rua rua R. Avenida Av. Travessa Largo Praça Estrada'.split())} {r.choice(('da ', 'do ', 'das ', 'de ', ''))}{r.choice((made(), r.choice('Flores Liberdade Igreja Fonte Escola República Alegria'.split())))}"
        polish = f"{r.choice('ul. ul. al. os. pl. ulica aleja'.split())} {r.choice((made(), r.choice('Długa Polna Leśna Ogrodowa Lipowa Krótka Szkolna Zielona'.split()), made() + ' ' + made()))}"
        turkish = f"{r.choice(('', '', made() + ' Mah. ', made() + ' Mahallesi '))}{r.choice((made(), r.choice('Atatürk Cumhuriyet Lale Gül İnönü Çınar Bahçe Yıldız Zafer Papatya'.split())))} {r.choice('Cad. Sok. Sk. Caddesi Sokağı Sokak Bulvarı Cd.'.split())}"
        russian = f"{r.choice(('ул. ', 'улица ', 'пр. ', 'пер. '))}{r.choice('Садовая Лесная Мира Победы Школьная Новая Речная Зелёная Ленина Пушкина'.split())}"
        other = r.choice((f"Via {made()}", f"Via {r.choice('Roma Garibaldi Verdi Dante'.split())}", f"{made()}straat", f"{made()}gatan", f"{made()}vej", f"{made()}laan", f"Piazza {made()}"))
        flat = r.choice((f"Flat {r.randint(1, 40)}, ", f"Apt {r.randint(1, 99)}, ", f"Unit {r.randint(1, 20)}, ", f"{r.randint(1, 20)}/", "", "", "", "", ""))
        code, zip_ = self.d(5), self.d(5) if r.random() < 0.5 else self.mask("99-999")
        forms = (
            lambda: f"{flat}{no} {english}", lambda: f"{no} {english}", lambda: f"{flat}{no} {english}, {town}", lambda: f"{no} {english}, {town} {self.mask(r.choice(('AA9 9AA', 'A99 9AA', '99999', 'AA 99999')))}", lambda: f"{no} {english} {r.choice(('Apt', 'Suite', 'Unit', '#'))} {r.randint(1, 99)}", lambda: f"{no} {r.choice(('N', 'S', 'E', 'W', 'North', 'West'))} {english}",
            lambda: f"{german} {no}", lambda: f"{german} {no}", lambda: f"{german} {no}, {code} {town}", lambda: f"{no}{r.choice(('', ',', ' bis', ' ter', ' bis,', ' ter,'))} {french}", lambda: f"{no}{r.choice(('', ','))} {french}, {code} {town}",
            lambda: f"{spanish}{r.choice((' ', ', ', ' nº ', ', nº '))}{no}", lambda: f"{spanish}{r.choice((' ', ', '))}{no}, {self.mask('8')}{r.choice('ºª')} {r.choice(('A', 'B', 'C', 'D', 'izq.', 'dcha.', '1', '2'))}", lambda: f"{portuguese}{r.choice((' ', ', ', ', n.º '))}{no}{r.choice(('', ', ' + self.mask('8') + 'º Esq', ', ' + self.mask('8') + '.º Dto'))}",
            lambda: f"{polish} {no}{r.choice(('', '/' + str(r.randint(1, 60)), ' m. ' + str(r.randint(1, 60))))}", lambda: f"{polish} {no}, {zip_} {town}", lambda: f"{turkish} {r.choice(('No:', 'No: ', 'No ', 'no:', ''))}{no}{r.choice(('', '/' + str(r.randint(1, 20)), ' D:' + str(r.randint(1, 20)), ' Daire ' + str(r.randint(1, 20))))}", lambda: f"{turkish} No: {no}, {town}",
            lambda: f"{russian}, {r.choice(('д. ', 'дом ', ''))}{r.randint(1, 150)}{r.choice(('', ', кв. ' + str(r.randint(1, 200))))}", lambda: f"{other}{r.choice((' ', ', '))}{no}",
        )
        out = r.choice(forms)()
        x = r.random()
        return out.upper() if x < 0.04 else out.lower() if x < 0.08 else out

    def i(self) -> str:
        """A number as it stands behind its name or as the value of a field."""
        return self.mask(self.r.choice(self.CLEAR)) if self.r.random() < 0.4 else self.sort()[1]

    def unit(self) -> str:
        r = self.r
        return f"{r.choice(_UNITS)} {r.choice((str(r.randint(0, 9)), str(r.randint(0, 99)), f'{r.randint(0, 99):02}', str(r.randint(0, 400))))}{r.choice(('', '', 'a', 'b', 'c', 'A', 'B', '/2', '-3'))}"

    def code(self) -> str:
        r = self.r
        number = self.mask(r.choice(("999-999-999", "999-999", "9999-9999", "999 999 999", "999-9999", "99 99 99", "9999.9999", "999/999/999", "99999999999", "99-99-99", "999999999", "99999999", "999-99-999", "9999 9999", "99999-99999", "999.999.999", "9999-99", "9999-99", "9999-9", "99999/99", "999-99", "AA-999-99-9999", "AAA-999-99-9999")))
        return f"{r.choice(_CODES)} {number}"

    def ref(self) -> str:
        r = self.r
        return self.mask(r.choice(("AA-99999", "AAA-9999", "AA/9999/99999", "AAA-2025-99999", "AA-999-99-9999", "AAA-999-99-9999-9", "A99-9999", "AAA999999999", "#99999", "9999-99", "99-9999-A", "AAA_9999", "A-9", "AA-9999-AA", "9999/99", "AAA/99/9999", "AA9999-99", "A99-9999-A", "AAA-9", "AA-9999999", "AA-99999999999", "A-99-A", "9999-9999-99")))

    def plain(self, pattern: str) -> str:
        r = self.r
        out, k = [], 0
        while k < len(pattern):
            c = pattern[k]
            if c != "{":
                out.append(c)
                k += 1
                continue
            f = pattern[k + 1]
            k += 3
            words = r.sample(_WORDS, 3)
            if f == "U":
                out.append(self.unit())
            elif f == "g":
                out.append(self.code())
            elif f == "w":
                out.append(" ".join(words[: r.choice((1, 1, 2))]).lower())
            elif f == "W":
                title = words[: r.choice((1, 2, 2, 2, 3))]
                out.append(r.choice((" ".join(title), " ".join(title), " ".join(title), " ".join(title), " ".join(title), f"the {' '.join(title)} {r.choice(('team', 'desk', 'office', 'branch'))}", title[0].lower() + "".join(title[1:]), "".join(title), f"{title[0]} {r.choice(('For', 'Of', 'And', 'To'))} {title[-1]}", "_".join(title).upper(), f"{self.made()} {r.choice(('GmbH', 'Ltd', 'SA', 'Bank', 'Group', 'branch', 'Logistics', 'AG', 'Inc.'))}", f"node-{self.d(2)}", f"{title[0]} {title[1] if len(title) > 1 else ''} #{self.d(2)}")))
            elif f == "r":
                out.append(self.ref())
            elif f == "k":
                out.append(str(r.choice((r.randint(0, 9), r.randint(0, 99), r.randint(0, 9999)))))
            elif f == "m":
                out.append(r.choice((self.mask("8999"), self.mask("899.99"), self.mask("8.999,99"), self.mask("8,999.99"), self.mask("89 999,99"), self.mask("89999.99"), self.mask("0.9999"), self.mask("89,999"), self.mask("89"))))
            elif f == "u":
                h = "".join(r.choices("0123456789abcdef", k=32))
                out.append(r.choice((f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}", h[:16], h, h[:7], f"0x{h[:8]}")))
            elif f == "l":
                out.append(self.d(r.choice((8, 9, 10, 11, 11, 12, 13, 14))))
            elif f == "v":
                out.append(r.choice((self.mask("8.9.9"), self.mask("v8.9"), self.mask("8.99.9999"), self.mask("20199-99"[:4] + "8-9"))))
            elif f == "t":
                out.append(r.choice((f"{r.randint(2019, 2027)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}T{r.randint(0, 23):02}:{self.d(2)}:{self.d(2)}Z", f"{r.randint(0, 23):02}:{r.randint(0, 59):02}", f"{r.randint(0, 23):02}:{r.randint(0, 59):02}:{r.randint(0, 59):02}.{self.d(3)}")))
            elif f == "D":
                out.append(r.choice((f"{r.randint(2019, 2027)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", f"{r.randint(1, 28):02}.{r.randint(1, 12):02}.{r.randint(2019, 2027)}", f"{r.randint(1, 12)}/{r.randint(1, 28)}/{r.randint(2019, 2027)}", f"{r.randint(1, 28)} {r.choice('March May August'.split())} {r.randint(2019, 2027)}")))
            elif f == "x":
                out.append(r.choice((".".join(str(r.randint(0, 255)) for _ in range(4)), f"svc@node-{self.d(2)}", f"job@{r.randint(1, 9)}", f"{r.choice(_WORDS).lower()}-{self.d(2)}.local", f"@{r.choice(_WORDS).lower()}", f"https://{self.host()}/{r.choice(_WORDS).lower()}/{self.d(4)}", f"retry@{self.d(1)}/{self.d(1)}")))
            elif f == "b":
                out.append(f"{self.caps(2)}{self.d(2)} {self.d(4)} {self.d(4)} {self.d(4)} {self.d(2)}")
            elif f == "c":
                out.append(f"{self.d(4)} {self.d(4)} {self.d(4)} {self.d(4)}")
        return "".join(out)

    def piece(self) -> tuple[str, list[tuple[int, int, str]]]:
        """A note: a piece of personal information in its surroundings, or none in the same surroundings, or a plain note."""
        r = self.r
        x = r.random()
        if x < 0.07:
            return self.plain(r.choice(("{r}", "{r}", "{r}", "{k}", "{m}", "{u}", "{l}", "{D}", "{t}", "{W}", "{g}", "{U}", "{b}"))), []
        if x < 0.16:
            return (f"{r.choice(_WORDS)} " if r.random() < 0.3 else f"{r.choice(self.SORTS)[0].split('|')[0]} " if r.random() < 0.3 else "") + r.choice(_COMMON), []
        if x < 0.36:
            return self.plain(r.choice(_PLAIN)), []
        if x < 0.52:
            return self.deed()
        kind = r.choice("nnnnnnneepppiiiiiiiaaaaa")
        before = r.choice(_BEFORE[kind]) if r.random() < 0.75 else ""
        after = r.choice(_AFTER)
        label = ""
        if x < 0.62:  # like text, but nobody is in it
            fill = self.plain(r.choice(("{W}", "{W}", "{w}", "{r}", "{r}", "{k}", "{l}", "{m}", "the {w}", "unknown", "not given", "-", "missing", "{x}" if kind != "e" else "{w}", "{D}", "{U}", "{U}", "{g}") if kind != "i" else ("{w}", "missing", "not given", "{w} {k}", "-")))
            mark: list[tuple[int, int, str]] = []
        else:
            label, fill = self.sort() if kind == "i" and r.random() < 0.85 else ("", getattr(self, kind)())
            if kind == "i" and not label:  # a form that needs no name
                fill = self.mask(r.choice(self.CLEAR[:9]))
            mark = [(len(label), len(label) + len(fill), kind)]
            fill = label + fill
            before = before if not label or r.random() < 0.15 else r.choice(("", "", "match on ", "checked: ", "with ", "has ", "(", "und ", "et ", "y ", "i ", "ve ")).strip()
        if r.random() < 0.08:
            before = before.upper()
        elif r.random() < 0.2:
            before = before[:1].upper() + before[1:]
        sep = r.choice((" ", " ", " ", " ", ": ", "=", ":", " - ")) if before and not before.endswith(":") else " " if before else ""
        tail = (after if after[:1] in ",(" else f" {after}" if after else "") + (r.choice((".", ".", "", "", "!")) if after else r.choice(("", "", ".")))
        tail = f", {tail[1:]}" if tail.startswith(" ") and r.random() < 0.1 else tail
        tail = f" {tail}" if tail.startswith("(") else tail
        head = f"{before}{sep}"
        marks = [(a + len(head), b + len(head), t) for a, b, t in mark]
        text = f"{head}{fill}{tail}"
        if mark and r.random() < 0.2:  # a second piece right behind
            second = r.choice("nepaai".replace(kind, ""))
            other = self.mask(r.choice(self.CLEAR[:9])) if second == "i" else getattr(self, second)()
            link = r.choice((", ", ", ", ", ", " (", " - ", "; ", " / ", " <", ", tel ", " at ", " on ", " au ", " and ", " or ", " und ", " et ", " y "))
            if second == "e" or link != " <":
                start = len(head) + len(fill) + len(link)
                text = f"{head}{fill}{link}{other}" + {" (": ")", " <": ">"}.get(link, "") + tail
                marks.append((start, start + len(other), second))
        return text, marks

    def deed(self) -> tuple[str, list[tuple[int, int, str]]]:
        """What somebody does, or something that only looks like somebody."""
        r = self.r
        nobody = r.random() < 0.25
        text, marks = "", []
        parts = self.r.choice(_DEEDS).split("{n}")
        for k, part in enumerate(parts):
            text += self.plain(part)
            if k + 1 < len(parts):
                name = self.plain(r.choice(("{W}", "{W}", "the {w}", "{U}"))) if nobody else self.n()
                if not nobody:
                    marks.append((len(text), len(text) + len(name), "n"))
                text += name
        if text.endswith(("phone", "mail", "au", "por")) and not nobody:
            kind = "e" if r.random() < 0.4 else "p"
            other = getattr(self, kind)()
            marks.append((len(text) + 1, len(text) + 1 + len(other), kind))
            text = f"{text} {other}"
        if r.random() < 0.3 and not (marks and marks[0][0] == 0):
            text = text[:1].upper() + text[1:]
        return text, marks

    def field(self) -> tuple[str, str, str | None]:
        """A key, its value, and the value's type."""
        r = self.r
        if r.random() < 0.45:
            return r.choice(_OTHER_KEYS), self.plain(r.choice(("{k}", "{r}", "{w}", "{W}", "{m}", "{u}", "{D}", "{t}", "true", "null", "{l}", "{v}"))), None
        kind = r.choice("nnnnepppiiaa")
        if r.random() < 0.25:
            return r.choice(_KEYS[kind]), self.plain(r.choice(("", "-", "null", "n/a", "none", "{W}", "{r}", "unknown", "{k}"))), None
        if kind == "i" and r.random() < 0.4:
            return r.choice(_KEYS[kind]), "".join(self.sort()), kind
        return r.choice(_KEYS[kind]), getattr(self, kind)(), kind

    def fields(self) -> tuple[str, list[tuple[int, int, str]]]:
        r, json_like = self.r, self.r.random() < 0.6
        text, marks = "{" if json_like else "", []
        for k in range(r.randint(1, 5)):
            key, value, kind = self.field()
            quoted = '"' if json_like else ""
            text += ((", " if json_like else r.choice(("; ", ", ", " ", "\n"))) if k else "") + f"{quoted}{key}{quoted}{(': ' if r.random() < 0.8 else ':') if json_like else r.choice(('=', '=', ': '))}"
            bare = json_like and kind is None and (value.isdigit() or value in ("true", "null")) or not json_like
            shown = value if bare else f'"{value}"'
            at = len(text) + (0 if bare else 1)
            text += shown
            if kind:
                marks.append((at, at + len(value), kind))
        return text + ("}" if json_like else ""), marks


def labelled_table(rows: int, seed: int = 7) -> Iterator[tuple[str, list[tuple[int, int, str]]]]:
    """``rows`` texts of one to four notes or fields, with the marked spans (start, end, type letter)."""
    f = Filler(seed)
    for _ in range(rows):
        if f.r.random() < 0.25:
            yield f.fields()
            continue
        text, spans = "", []
        joint = f.r.choice(("; ", "\n", " - ", ". ", " ", " | "))
        for _ in range(f.r.choice((1, 1, 1, 2, 2, 3, 4))):
            s, marks = f.piece()
            at = len(text) + (len(joint) if text else 0)
            text = f"{text}{joint}{s}" if text else s
            spans += [(a + at, b + at, t) for a, b, t in marks]
        yield text, spans
