import pytest

from webloom.llm import residue

CASES = [
    ("Hello [YOUR NAME HERE], your order #{order.id} leaves our store on XX/XX/XXXX.", "slot"),
    ("The careful relay lost three players to {{ cause }} in the last game. A long debate followed.", "slot"),
    ("Page not found", "error"),
    ("404\nPerhaps one of these helps:\nWinter kitchen answer Taltal\nLocal ledger return", "error"),
    ("Fatal error: memory exhausted\n    at a.load (/srv/x/y.js:15:51)\n    at b.render (/srv/x/z.js:41:30)", "error"),
    ("Bitte aktivieren Sie JavaScript, um diese Seite zu sehen.", "script"),
    ("Ohne Skripte kann diese Anwendung nicht geladen werden.", "script"),
    ("Lorem ipsum dolor amet magnis. Turpi donec erit, ornara dolor quam lectis elita augue magnis.", "filler"),
    ("text goes here text goes here text goes here", "filler"),
    ("xxxx xxx xxxxx " * 10, "filler"),
    (None, None),
    ("", None),
    (" \n\t\n", None),
    ("Room 404 is on the fourth floor, next to the lift. The key is at the desk.", None),
    ("In a shell script, ${HOME} expands to the user’s directory. The rest of the text is about something else.", None),
    ("Write {{ user_name }} where the greeting should show the reader’s name, and the engine fills it in later.", None),
    ("When the value is missing, the old build printed undefined in its log. It was mended.", None),
    ("The syntax %s in a format string stands for text, and {0} for the first argument.", None),
    ("The server answers with code 404 when a page has been moved, and the log then says “page not found”. That is all there is to it.", None),
    ("if (slot === null) return next();  # griban\nA real sentence stands below the code and tells of it.", None),
    ("".join(f"A long and honest article tells of garden {i} and of path {i * 7}. " for i in range(3000)) + " ".join(f"word{chr(97 + i % 26)}{i}" for i in range(3000)), None),
]


@pytest.mark.parametrize(("text", "kind"), CASES)
def test_kinds(text, kind):
    assert residue.inspect(text)[0] == kind


def test_operator(spark):
    rows = [(i, t, "clash", 0.5) for i, (t, _) in enumerate(CASES)] + [(100, CASES[0][0], None, None)]
    df = spark.createDataFrame(rows, "page_id long, content string, residue_kind string, covered double")
    found = residue.find_residue(df, "page_id")
    assert found.columns == ["page_id", "residue_kind", "covered", "slots"]
    assert sorted(r.page_id for r in found.collect()) == [i for i, (_, k) in enumerate(CASES) if k] + [100]
    assert residue.find_residue(df.where("false"), "page_id").count() == 0


@pytest.mark.parametrize("slot", ["{{ " + "customer.address | default(none) | " * 4 + "upper }}", "[insert " + "the long name of the place " * 4 + "here]", "%" + "VERY_LONG_NAME_" * 5 + "X%"])
def test_long_slots(slot):
    assert residue.inspect(f"Dear {slot}, your order has been shipped today.")[0] == "slot"


#: Wording of pages in the wild that stands in none of the test tables.
HELD_OUT = """
JavaScript must be enabled to continue.
This site requires JavaScript to work properly.
Your browser does not support JavaScript.
To use this application, please turn on JavaScript and reload.
We're sorry but this app doesn't work properly without JavaScript enabled.
Scripts are required to display this content.
JavaScript seems to be disabled in your browser.
Bitte schalten Sie JavaScript ein.
Diese Seite benötigt JavaScript.
Für diese Anwendung ist JavaScript erforderlich.
Ce site nécessite JavaScript pour fonctionner.
Veuillez autoriser les scripts dans votre navigateur. JavaScript est désactivé.
Este sitio requiere JavaScript.
Por favor, habilite JavaScript en su navegador.
Por favor, habilite o JavaScript para continuar.
Este site requer JavaScript.
Per continuare è necessario abilitare JavaScript.
Questo sito richiede JavaScript.
JavaScript is uitgeschakeld in uw browser.
Deze website vereist JavaScript.
Для работы сайта необходим JavaScript.
В вашем браузере отключен JavaScript.
Ta strona wymaga JavaScript.
Włącz obsługę JavaScript w przeglądarce.
Aktivera JavaScript för att fortsätta.
Bu sayfa için JavaScript gerekli.
JavaScriptを有効にしてください。
请启用JavaScript后继续。
자바스크립트를 활성화해 주세요.
Sorry, this page isn't available.
The page you requested does not exist.
We can't find the page you're after.
The link you followed may be broken, or the page may have been removed.
This content is no longer available.
Oops! That page can’t be found.
The server encountered an internal error and was unable to complete the request. Please try again.
An error occurred while processing your request.
Error establishing a database connection. Connection refused.
You do not have permission to access this resource.
Your connection has timed out.
The service is temporarily unavailable.
The website is under maintenance.
Your request has been blocked by the security check.
Verify you are human by completing the action below.
This account has been disabled.
This link has expired.
504 Gateway Timeout
The requested URL was rejected. Access denied.
Too many requests, slow down.
Unusual traffic from your network was detected.
Die Seite konnte nicht gefunden werden.
Diese Seite existiert nicht mehr. Die Seite wurde gelöscht.
Es ist ein Fehler aufgetreten. Versuchen Sie es später erneut.
Der Server ist derzeit nicht erreichbar.
Ihre Sitzung ist abgelaufen.
Sie haben keine Berechtigung für diese Seite.
Cette page n'existe pas.
La page que vous cherchez est introuvable.
Le service est momentanément indisponible.
Votre session a expiré.
Une erreur est survenue, veuillez réessayer.
La página que busca no existe.
El servicio no está disponible en este momento.
Ha ocurrido un error. Inténtelo más tarde.
Su sesión ha caducado. La sesión ha expirado.
A página que procura não foi encontrada.
O serviço está temporariamente indisponível.
Ocorreu um erro. Tente novamente mais tarde.
La pagina richiesta non esiste.
Si è verificato un errore, riprova più tardi.
Il servizio non è disponibile.
De pagina die u zoekt bestaat niet.
Er is een fout opgetreden. Probeer het opnieuw.
De dienst is tijdelijk niet beschikbaar.
Такой страницы не существует.
К сожалению, страница не найдена.
Сервис временно недоступен.
Strona nie została znaleziona.
Sidan kunde inte hittas: sidan finns inte.
Siden blev ikke fundet.
Sivua ei löytynyt.
Stránka nebyla nalezena.
Sayfa bulunamadı.
お探しのページは見つかりませんでした。
您访问的页面不存在。
페이지를 찾을 수 없습니다.
Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.
Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.
Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.
Your text here.
Insert text here.
Dummy content for testing.
Click to edit this heading.
Welcome to WordPress. This is your first post. Edit or delete it.
Hier steht Ihr Text.
Votre texte ici.
Tu texto aquí.
Il tuo testo qui.
qwerty asdf zxcv
Hi [First Name], welcome back to the shop.
Dear {FIRST_NAME}, your parcel has left.
Hello *|FNAME|*, here is the letter of the week.
Dear {!Contact.FirstName}, thank you for the call.
Hallo %recipient.name%, uw bestelling is onderweg.
Price on <?php echo $date; ?> for all rooms.
""".strip().split("\n")


def test_held_out_wording():
    assert len(HELD_OUT) >= 100
    missed = [x for x in HELD_OUT if residue.inspect(x)[0] is None]
    assert len(missed) <= 0.1 * len(HELD_OUT), missed


def test_held_out_wording_is_not_in_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("content").where("content is not null")
    lines = {r.l.strip() for r in pages.selectExpr("explode(split(content, '\n')) l").distinct().collect()}
    assert not lines & set(HELD_OUT)


def test_ordinary_prose_is_kept():
    for text in (
        "The museum page of the town lists what visitors may see. A guide walks with each group, and tickets are sold at the door.",
        "JavaScript is the language of the browser. Its first version took ten days to write. Many people still argue about its merits over coffee.",
        "The court said that access to the archive may not be denied. Two judges wrote a dissent. The case goes back to the lower court in May.",
        "Our baker sells rye bread. He opens at six.",
        "Latin verbs are easy: amo, amas, amat. The class learns them in a week.",
        "He wrote [sic] in the margin, and the editor [of the first edition] kept it.",
    ):
        assert residue.inspect(text)[0] is None, text
