"""Problem 1: template residue, filler, error and script-demand text.

A multi-pattern automaton finds every residue phrase and every slot opener of a whole text in one
pass.  Slots are verified where the automaton found their opener.  Sentences that its phrases give
away become covered characters, and a text is residue when the covered share of its prose is high.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from webloom.llm.arrow import map_rows, text_column

#: Stems of general wording, lower case, digits as 0, by language.  A sentence speaks of
#: an error if it names a thing and what is wrong with it, of scripts if it names them and demands
#: them; whole phrases stand for themselves.
ERROR_THINGS = """
en: page|site|website|url|link|address|resource|file|document|content|server|gateway|service|request|session|account|domain|database|connection|access|error|exception|network|traffic|browser|backend|upstream|permission|maintenance|host|certificate
de: seite|adresse|ressource|datei|dokument|server|dienst|anfrage|sitzung|konto|domain|datenbank|verbindung|zugriff|zugang|fehler|wartung|inhalt
fr: page|site|adresse|ressource|fichier|document|serveur|service|requête|session|compte|domaine|connexion|accès|erreur|maintenance|contenu
es: página|sitio|dirección|recurso|archivo|documento|servidor|servicio|solicitud|petición|sesión|cuenta|dominio|conexión|acceso|error|mantenimiento|contenido
pt: página|site|endereço|recurso|arquivo|ficheiro|servidor|serviço|pedido|solicitação|sessão|conta|domínio|conexão|ligação|acesso|erro|manutenção|conteúdo
it: pagina|sito|indirizzo|risorsa|file|server|servizio|richiesta|sessione|account|dominio|connessione|accesso|errore|manutenzione|contenuto
nl: pagina|site|adres|bron|bestand|server|dienst|verzoek|aanvraag|sessie|account|domein|verbinding|toegang|fout|onderhoud|inhoud
ru: страниц|сайт|адрес|ресурс|файл|сервер|сервис|запрос|сесси|сеанс|аккаунт|учётн|учетн|домен|соединени|доступ|ошибк|техническ
pl: stron|adres|zasób|plik|serwer|usług|żądani|sesj|konto|domen|połączeni|dostęp|błąd|błęd
sv: sidan|sida|adress|resurs|fil|servern|tjänst|begäran|session|konto|domän|anslutning|åtkomst|fel|underhåll
da: siden|side|adresse|ressource|serveren|tjeneste|anmodning|session|konto|domæne|forbindelse|adgang|fejl|vedligehold
fi: sivu|osoite|palvelin|palvelu|pyyntö|istunto|tili|yhteys|pääsy|virhe
cs: stránk|adres|soubor|server|služb|požadavek|relac|účet|domén|připojení|přístup|chyb
tr: sayfa|adres|sunucu|hizmet|istek|oturum|hesap|bağlantı|erişim|hata
ja: ページ|サイト|サーバ|アクセス|エラー|接続|アカウント|セッション
zh: 页面|頁面|网页|網頁|网站|網站|服务器|伺服器|访问|訪問|请求|請求|连接|连线
ko: 페이지|사이트|서버|접근|접속|요청|오류|세션
"""
ERROR_FAULTS = """
en: not found|not be found|be located|not find|couldn't find|can't find|can’t find|couldn’t find|nothing was found|nothing found|not exist|n't exist|n’t exist|no longer exist|no longer available|not available|n't available|n’t available|has moved|have moved|been moved|been removed|been deleted|been renamed|been suspended|been disabled|been blocked|been denied|is parked|unavailable|went wrong|has gone wrong|an error occurred|error has occurred|error while processing|try again|retry|try later|has expired|have expired|timed out|time-out|timeout|did not answer|not respond|n't respond|denied|forbidden|not permitted|not authorized|not authorised|unauthorized|not allowed|have permission|too many|slow down|rate limit|internal server|bad gateway|bad request|bad upstream|fetch failed|connection refused|refused to connect|mistyped|misspelled|down for|under maintenance|maintenance mode|be back soon|be back shortly|unhandled|uncaught|fatal error|stack trace|segmentation fault|memory exhausted|memory limit|not defined|null pointer|are human|you are a human|not a robot|checking your|security check|captcha|unusual traffic|unusual activity|be reset
de: nicht gefunden|nicht finden|nicht auffindbar|nicht verfügbar|nicht erreichbar|nicht mehr|existiert nicht|nicht existiert|gibt es nicht|verschoben|gelöscht|entfernt|ist ein fehler|fehler aufgetreten|unerwarteter fehler|schiefgegangen|schiefgelaufen|erneut|später noch einmal|abgelaufen|verweigert|gesperrt|keine berechtigung|nicht berechtigt|zu viele|wartungsarbeiten|fehlgeschlagen
fr: introuvable|pas trouvé|non trouvé|n'existe|n’existe|plus disponible|pas disponible|indisponible|été déplacé|déplacée|supprimé|erreur est survenue|erreur s'est produite|erreur s’est produite|interne est survenue|réessayer|réessayez|expiré|refusé|interdit|non autorisé|trop de|en maintenance|échoué
es: no encontrad|no se encontr|no se ha encontrado|no existe|ya no existe|no está disponible|no disponible|ha sido movid|ha cambiado|se ha movido|eliminad|ha ocurrido|ha producido|ocurrió un error|salió mal|inténtelo|vuelva a intentar|intente de nuevo|inténtalo|caducad|expirad|denegad|prohibid|no autorizad|demasiad|mantenimiento
pt: não encontrad|não foi encontrad|não existe|não está disponível|indisponível|foi movid|foi removid|ocorreu um erro|algo deu errado|correu mal|tente novamente|tente de novo|expirou|negad|proibid|não autorizad|muitas solicitações|demasiados pedidos|em manutenção
it: non trovat|non è stata trovata|non esiste|non è disponibile|non disponibile|è stata spostata|rimoss|si è verificato|qualcosa è andato storto|riprova|scadut|negat|vietat|non autorizzat|troppe richieste|in manutenzione
nl: niet gevonden|niet vinden|bestaat niet|niet beschikbaar|niet bereikbaar|verplaatst|verwijderd|fout opgetreden|ging iets mis|ging fout|opnieuw|verlopen|geweigerd|verboden|geen toestemming|te veel
ru: не найден|не существует|не удалось найти|недоступ|больше не|перенес|перенёс|перемещ|удален|удалён|произошла|что-то пошло не так|попробуйте|повторите|истек|истёк|запрещ|отказано|слишком много|техническ
pl: nie znalezion|nie została znaleziona|nie istnieje|niedostępn|przeniesion|usunięt|wystąpił|coś poszło nie tak|spróbuj ponownie|wygasł|odmow|zabronion|zbyt wiele
sv: hittades inte|hittas inte|finns inte|inte tillgänglig|flyttats|tagits bort|gick fel|inträffade|försök igen|har gått ut|nekad|förbjud|för många
da: ikke fundet|ikke findes|findes ikke|ikke tilgængelig|blevet flyttet|gik galt|opstod|opstået|prøv igen|udløbet|nægtet|ingen adgang|for mange
fi: ei löyt|ei ole olemassa|ei ole saatavilla|siirretty|poistettu|meni vikaan|tapahtui virhe|yritä uudelleen|vanhentunut|estetty|kielletty|liian monta
cs: nenalezen|nebyla nalezena|neexistuje|nedostupn|přesunut|odstraněn|došlo k|něco se pokazilo|zkuste to znovu|vypršel|odepřen|zakázán|příliš mnoho
tr: bulunamadı|mevcut değil|artık yok|taşındı|taşınmış|kaldırıldı|silinmiş|ters gitti|oluştu|tekrar deneyin|süresi doldu|reddedildi|engellendi|çok fazla
ja: 見つかりません|見つかりませんでした|存在しません|ご利用いただけません|移動|削除され|発生しました|再度お試し|もう一度お試し|有効期限|拒否|禁止|権限がありません
zh: 找不到|未找到|不存在|无法访问|無法訪問|不可用|已移动|已被删除|已删除|出错|出现错误|发生错误|稍后再试|稍後再試|请重试|过期|拒绝|拒絕|禁止|没有权限
ko: 찾을 수 없|존재하지 않|사용할 수 없|이동|삭제|발생했습니다|다시 시도|만료|거부|금지|권한이 없
"""
ERROR_PHRASES = """
en: what you were looking for|what you are looking for|what you're looking for|what you’re looking for|page you were looking for|page you are looking for|page you requested|requested page|requested url|perhaps one of these helps|try one of these|maybe try a search|return to the home page|go back to the homepage|nothing was found at this location|error 0|http 0|0 not found|0 forbidden|0 bad gateway|0 service unavailable|0 internal server error|something went wrong|access denied|page not found|not found|make an offer|this domain may be for sale|this domain is for sale|verify you are human|prove that you are human|i'm not a robot|too many requests|unhandled exception|uncaught exception|fatal error|internal server error|bad gateway|service unavailable|gateway timeout
de: vielleicht hilft eines davon|zur startseite zurück|zugriff verweigert|seite nicht gefunden
fr: accès refusé|page introuvable|retour à l'accueil|retour à l’accueil
es: acceso denegado|página no encontrada|volver al inicio
pt: acesso negado|página não encontrada
it: accesso negato|pagina non trovata
nl: toegang geweigerd|pagina niet gevonden
ru: доступ запрещён|доступ запрещен|страница не найдена
"""
SCRIPT_THINGS = """
en: javascript|java script|scripts|scripting|noscript|client-side code|ad blocker|adblock
de: javascript|skripte|skripten|scripte|werbeblocker
fr: javascript|scripts|bloqueur
es: javascript|scripts|bloqueador
pt: javascript|scripts|bloqueador
it: javascript|script|ad blocker
nl: javascript|scripts|adblocker
ru: javascript|джаваскрипт|скрипт
pl: javascript|skrypt
sv: javascript|skript
tr: javascript
ja: javascript|スクリプト
zh: javascript|脚本|腳本
ko: javascript|자바스크립트|스크립트
"""
SCRIPT_DEMANDS = """
en: enable|turn on|turned on|switch on|allow|activate|required|requires|require|needs|need to|you need|must|disabled|turned off|turn off|not enabled|not supported|does not support|doesn't support|doesn’t support|not support|without|only with|unable|cannot|can't|won't|not load|reload
de: aktivier|einschalten|schalten|erlauben|zulassen|benötigt|erforderlich|notwendig|deaktiviert|ausgeschaltet|unterstützt|ohne|nicht geladen
fr: activer|activez|autoriser|autorisez|nécessite|requis|désactivé|sans|ne prend pas en charge
es: activ|habilit|permit|necesita|requiere|requerido|necesario|desactivado|deshabilitado|sin
pt: ativ|habilit|permit|necessita|requer|necessário|desativado|sem
it: attiv|abilit|consent|richiede|necessario|disattivato|disabilitato|senza
nl: schakel|inschakelen|activeer|sta toe|vereist|nodig|uitgeschakeld|zonder
ru: включите|включить|разрешите|требуется|необходим|отключен|отключён|выключен|без
pl: włącz|wymaga|wymagan|wyłączon|zezwól|bez
sv: aktivera|slå på|krävs|kräver|avaktiverat|utan
tr: etkinleştir|gerekli|gerektirir|devre dışı
ja: 有効|必要|無効
zh: 启用|啟用|开启|開啟|需要|禁用|支持
ko: 활성화|필요|사용하도록|비활성
"""
FILLER_PHRASES = """
en: lorem ipsum|sample paragraph|sample text|sample description|sample product|example text|placeholder|content block|text block|lead paragraph|paragraph text|caption text|button text|dummy text|dummy copy|dummy content|filler text|text goes here|goes here|goes in this field|your text here|your content here|your content will appear|insert text here|type your text|type here|add your text|add text here|enter text here|edit this text|replace this text|replace it with|click to edit|add a short bio|write something about yourself|hello world! this is your first post|welcome to wordpress|coming soon: content|to be supplied|content to follow|text to follow|description here|title here|this is a test|test test
de: blindtext|beispieltext|platzhalter|text einfügen|hier steht ihr text|hier kommt der text|dummytext|mustertext
fr: texte provisoire|faux texte|texte d'exemple|texte d’exemple|texte fictif|votre texte ici|insérez votre texte|texte à remplacer
es: texto de prueba|texto de ejemplo|texto de relleno|texto ficticio|su texto aquí|tu texto aquí|aquí va el texto
pt: texto de exemplo|texto fictício|texto de teste|seu texto aqui|insira o texto|texto provisório
it: testo di esempio|testo segnaposto|testo fittizio|testo di prova|inserisci il testo|il tuo testo qui
nl: voorbeeldtekst|opvultekst|plaatshouder|tijdelijke tekst|uw tekst hier|voer tekst in
ru: текст-заполнитель|пример текста|образец текста|здесь будет текст|введите текст|текст-рыба
pl: przykładowy tekst|tekst zastępczy|wpisz tekst
sv: exempeltext|platshållare|skriv text här
tr: örnek metin|yer tutucu
ja: ダミーテキスト|サンプルテキスト|テキストを入力
zh: 占位文本|示例文本|在此输入|假文
ko: 더미 텍스트|예시 텍스트|텍스트를 입력
"""
#: The vocabulary of mock Latin, and keys typed at random.
MOCK_LATIN = (
    "lorem ipsum dolor amet consectetur adipiscing elit eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip "
    "commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa officia deserunt mollit anim "
    "laborum accumsan aenean aliquam aliquet ante arcu auctor augue bibendum blandit condimentum congue consectetuer convallis cras curabitur cursus dapibus diam dictum dictumst dignissim "
    "donec egestas eget eleifend elementum erat eros etiam euismod facilisi facilisis fames faucibus felis fermentum feugiat fringilla fusce gravida habitant habitasse hendrerit iaculis "
    "imperdiet integer interdum justo lacinia lacus laoreet lectus leo libero ligula lobortis luctus maecenas magnis malesuada massa mattis mauris metus mollis molestie morbi nascetur "
    "natoque nec neque netus nibh nisl nullam nunc odio orci ornare parturient pellentesque penatibus pharetra phasellus placerat platea porta porttitor posuere potenti praesent pretium "
    "pulvinar purus quam quisque rhoncus ridiculus risus rutrum sagittis sapien scelerisque semper senectus sociosqu sodales sollicitudin suscipit suspendisse tellus tempus tincidunt "
    "tortor tristique turpis ultrices ultricies urna varius vehicula vel venenatis vestibulum vitae vivamus viverra volutpat vulputate"
).split()
#: Letters of a mock Latin word that decide; words built on its stems count too.
LATIN_STEM = 4
KEY_MASH = "asdf asdfg asdfgh jkl qwer qwert qwerty zxcv zxcvb yxcv yxcvb hjkl jkl jklö uiop tzui dfgh fghj sdfg azerty йцукен фыва фывапролд ячсмить xxx xxxx xxxxx xxxxxx blah blabla".split()
#: Names of the fields that bracketed slots stand for.
FIELD = (
    "name|first ?name|last ?name|surname|full ?name|user ?name|title|subject|headline|company|business|organi[sz]ation|city|town|state|country|street|address|zip|postcode|phone|telephone|mobile|"
    "e-?mail|website|url|link|date|time|day|month|year|price|amount|total|product|item|order|number|quantity|code|image|photo|logo|text|content|description|body|footer|greeting|signature|"
    "recipient|sender|customer|client|member|guest|vorname|nachname|firma|datum|ort|preis|anrede|prénom|nom|société|ville|prix|nombre|apellido|empresa|fecha|ciudad|precio|nome|cognome|azienda|"
    "città|prezzo|cidade|preço|naam|voornaam|achternaam|bedrijf|stad|prijs|имя|фамилия|дата|город|цена"
)
#: Slot openers, each with the pattern of the whole slot.
SLOTS = [
    ("{{", r"\{\{\{?[^{}\n]+\}?\}\}"),
    ("${", r"\$\{[^{}\n]+\}"),
    ("#{", r"#\{[^{}\n]+\}"),
    ("<%", r"<%=?[^%\n]+%>"),
    ("<?", r"<\?(?:php|=)[^\n]+?\?>"),
    ("{%", r"\{%[^%\n]+%\}"),
    ("{$", r"\{\$[A-Za-z_][^{}\n]*\}"),
    ("{!", r"\{![A-Za-z_$][^{}\n]*\}"),
    ("[[", r"\[\[[^\[\]\n]+\]\]"),
    ("[%", r"\[%[^%\n]+%\]"),
    ("<<", r"<<[A-Za-z][^<>\n]+>>"),
    ("«", rf"(?i)«(?:{FIELD})»"),
    ("*|", r"\*\|[A-Za-z_][^|\n]*\|\*"),
    ("%%", r"%%[A-Za-z][\w. ]*%%"),
    ("%", r"%(?:[A-Z][A-Z_]{2,}|[a-z]+[_.][a-z_.]+)%"),
    ("@@", r"@@[A-Za-z_]{2,}@@"),
    ("##", r"##[A-Za-z_]{2,}##"),
    ("__", r"__[A-Z][A-Z_]{2,}__"),
    ("{", rf"\{{(?:[a-z_][a-z_.]{{2,}}|\d|[A-Z][A-Z_]{{2,}}|(?i:{FIELD}))\}}"),
    ("[", rf"\[(?i:your|insert|enter|add|ihr|ihre|votre|su|seu|tuo|uw|ваш|ваше) [^\]\n]+\]|\[(?i:(?:[\w-]+[ _])?(?:{FIELD})(?:[ _](?:{FIELD}|here|\d))?)\]|\[[A-Z]{{2,}}(?:[_ ][A-Z]{{2,}})+\]"),
    ("<", rf"<(?i:insert|your|enter) [^<>\n]+>|<(?:[A-Z]{{2,}}[_ ])*(?:{FIELD.upper()})>"),
    ("[object object]", r"\[object Object\]"),
    ("xx/xx/xxxx", r"XX/XX/XXXX"),
    ("dd/mm/yyyy", r"DD/MM/YYYY"),
    ("$", r"\$[A-Z][A-Z_]{2,}\$"),
    ("tbd_", r"TBD_\w+"),
    ("undefined", r"\bundefined\b"),
]
#: Words by which prose talks about notation instead of using it.
METALANGUAGE = set(
    "argument arguments brace braces bracket brackets compiler debugger delimiter directive engine escaped evaluates expand expands expression fills format formatter interpolation interpreter "
    "literal macro markup notation null parameter parameters parser placeholder placeholders printed prints renderer renders replaced replaces runtime script scripts shell snippet string strings "
    "substituted substitutes substitution syntax template templates templating token tokens value values variable variables platzhalter vorlage variable zeichenkette ausdruck gabarit chaîne "
    "paramètre plantilla cadena parámetro modello segnaposto stringa parametro marcador sjabloon tekenreeks шаблон переменная строка".split()
)
#: Code by its own signs, after a trailing comment is taken off.
COMMENT = re.compile(r"\s{2,}(?:#|//|--)\s.*$")
CODE_LINE = re.compile(r"^\s*(?:export \w+=|import |from \w+ import|def |class \w+[(:]|if \(|for \(|while \(|return |const |let |var |curl |git |sudo |pip |npm |SELECT |#include|\$ )|[;{]\s*$|\w\(.*\)\s*;?\s*$|^\s*\w+(?:\.\w+)*\s*=\s*[^=\s]+\s*$")
FRAME = re.compile(r"^\s*(?:at [\w.$<>]+ ?\([^()\n]*:\d+(?::\d+)?\)|File \"[^\"]+\", line \d+.*)\s*$")
SERVER_TRACE = re.compile(r"(?i)^(?:warning|fatal|traceback|notice|error|exception)\b.*(?:\bon line \d+|\bat [\w.]+:\d+|\(most recent call last\):?)\s*$")
DIGITS = re.compile("[0-9]+")
SLOT_SIGN = re.compile(r"[\[{}<%@_$#«*]|XX/|DD/|TBD|undefined")
SENTENCE = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])")
PROSE_END = re.compile(r"[.!?…。！？:;”\")]\s*$")
COVERAGE = 0.5
WORDS = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
QUOTE = "“\"«‘„‹"
#: Longer sentences are covered only where a phrase stands, not as a whole.
SENTENCE_WORDS = 20


def stems(table: str) -> list[str]:
    """The stems of all languages, each once."""
    return list(dict.fromkeys(x for line in table.strip().split("\n") for x in line.split(": ", 1)[1].split("|")))


def is_code(line: str) -> bool:
    return bool(CODE_LINE.search(COMMENT.sub("", line)))


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    table: dict[str, list[tuple]] = {}
    for kind, role, phrases in (
        ("error", "thing", ERROR_THINGS), ("error", "fault", ERROR_FAULTS), ("error", "whole", ERROR_PHRASES), ("script", "thing", SCRIPT_THINGS), ("script", "fault", SCRIPT_DEMANDS),
        ("filler", "whole", FILLER_PHRASES),
    ):
        for phrase in stems(phrases):
            table.setdefault(phrase, []).append((kind, role, len(phrase)))
    for opener, pattern in SLOTS:
        table.setdefault(opener, []).append(("slot", re.compile(pattern), len(opener)))
    for key, values in table.items():
        found.add_word(key, values)
    found.make_automaton()
    return found


def _fold(line: str) -> str:
    return DIGITS.sub("0", " ".join(line.split()).lower())


def _slots(line: str) -> list[tuple[int, int]]:
    """Spans of unfilled slots; sentences that explain slots have none."""
    spans: set[tuple[int, int]] = set()
    lowered = line.lower()
    if len(lowered) != len(line):
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in line)
    for end, values in automaton().iter(lowered):
        for value in values:
            if value[0] == "slot" and (m := value[1].match(line, end - value[2] + 1)):
                spans.add(m.span())
    kept: list[tuple[int, int]] = []
    for span in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not kept or span[0] >= kept[-1][1]:
            kept.append(span)
    if not kept:
        return []
    bounds, at = [], 0
    for m in SENTENCE.finditer(line):
        bounds.append((at, m.start()))
        at = m.end()
    bounds.append((at, len(line)))
    out = []
    for a, b in bounds:
        inside = [s for s in kept if a <= s[0] < b]
        if not inside:
            continue
        rest = set(WORDS.findall(lowered[a:b]))
        if len(inside) == 1 and len(rest & METALANGUAGE) >= 2:
            continue
        out += inside
    return out


@lru_cache(1)
def _mock() -> tuple[frozenset[str], frozenset[str]]:
    return frozenset(w[:LATIN_STEM] for w in MOCK_LATIN), frozenset(KEY_MASH)


@lru_cache(20_000)
def _covered(line: str) -> tuple[int, frozenset[str]]:
    """Covered characters of a folded line and the kinds that cover it, sentence by sentence.

    A sentence is covered if it holds a whole phrase, or both the thing and the fault of one kind;
    a sentence that is mostly mock Latin or random keys is filler.  One that quotes such wording is not covered.
    """
    latin, mash = _mock()
    words = line.split()
    odd = sum(w[:LATIN_STEM] in latin or w in mash for w in words) >= 0.2 * len(words)
    hits = [(end - v[2] + 1, end + 1, v[0], v[1]) for end, values in automaton().iter(line) for v in values if v[0] != "slot"]
    if not odd and not _kinds(hits):
        return 0, frozenset()
    kinds: set[str] = set()
    covered = at = 0
    for sentence in SENTENCE.split(line):
        start = line.find(sentence, at)
        at = start + len(sentence)
        words = WORDS.findall(sentence)
        if not words:
            continue
        size = len(sentence) + (at < len(line))
        known = sum(w[:LATIN_STEM] in latin and len(w) >= LATIN_STEM for w in words)
        if (known >= 2 and known >= 0.6 * len(words)) or sum(w in mash for w in words) >= 0.6 * len(words):
            kinds.add("filler")
            covered += size
            continue
        inside = [h for h in hits if start <= h[0] and h[1] <= at]
        if any(h[0] and line[h[0] - 1] in QUOTE for h in inside):
            continue  # what quotes such wording talks about it
        inside = [h for h in inside if _stands(line, *h)]
        found = _kinds(inside)
        if found and len(words) <= SENTENCE_WORDS:
            kinds |= found
            covered += size
        elif found:
            whole = [h for h in inside if h[3] == "whole"]
            kinds |= {h[2] for h in whole}
            covered += sum(b - a for a, b, *_ in whole)
    return min(covered, len(line)), frozenset(kinds)


def _kinds(hits: list[tuple[int, int, str, str]]) -> set[str]:
    """The kinds of which there is a whole phrase, or a thing and a fault."""
    roles: dict[str, set[str]] = {}
    for _, _, kind, role in hits:
        roles.setdefault(kind, set()).add(role)
    return {kind for kind, r in roles.items() if "whole" in r or {"thing", "fault"} <= r}


def _stands(line: str, start: int, end: int, kind: str, role: str) -> bool:
    """Whether a stem begins a word and, where it is short, also ends one."""
    before, after = line[start - 1] if start else "", line[end : end + 1]
    if before.isalpha() and ord(before) < 0x3000:
        return False
    return not (kind == "error" and role == "fault" and end - start < 8 and after.isalpha() and ord(after) < 0x250)


def inspect(text: str | None) -> tuple[str | None, float, int]:
    """(kind or None, covered share of the prose, number of slots) of one whole text."""
    if not text or not text.strip():
        return None, 0.0, 0
    slots = matched = prose = 0
    kinds: dict[str, int] = {}
    for raw in text.split("\n"):
        if not raw.strip():
            continue
        if SLOT_SIGN.search(raw) and not is_code(raw):
            slots += len(_slots(raw))
        line = _fold(raw)
        if FRAME.match(raw) or SERVER_TRACE.match(raw.strip()):
            n, found = len(line), {"error"}
        elif re.fullmatch(r"0", line):
            n, found = 0, set()
        else:
            n, found = _covered(line)
        if n < 0.6 * len(line):
            prose += len(line) if PROSE_END.search(line) or len(line) > 120 else 0
            matched += n if n and PROSE_END.search(line) else 0
            prose -= n if n and PROSE_END.search(line) else 0
            continue
        matched += n
        for kind in found:
            kinds[kind] = kinds.get(kind, 0) + n
    share = matched / (matched + prose) if matched else 0.0
    if slots:
        return "slot", share, slots
    if share >= COVERAGE:
        return max(kinds, key=kinds.get) if kinds else "error", share, 0
    return None, share, 0


def find_residue(df: DataFrame, key: str, text: str = "content") -> DataFrame:
    """(key, residue_kind, covered, slots), a row for each text with residue.

    Null and blank texts have no residue; repeated rows each count; texts are read whole; other
    columns of ``df`` are ignored, whatever their names.  An empty input gives no rows.
    """
    kind = dict(df.dtypes)[key]

    def make():
        def expand(k, value):
            found, share, slots = inspect(value)
            return [(k, found, float(share), slots)] if found else []

        return expand

    return map_rows(df.select(df[key], text_column(df, text)), f"{key} {kind}, residue_kind string, covered double, slots int", make)


def without_residue(df: DataFrame, key: str, text: str = "content") -> DataFrame:
    """(key, text): the rows that ``find_residue`` does not name, null and blank texts included."""
    kind = dict(df.dtypes)[key]

    def make():
        def expand(k, value):
            return [] if inspect(value)[0] else [(k, value)]

        return expand

    return map_rows(df.select(df[key], text_column(df, text).alias(text)), f"{key} {kind}, {text} string", make)
