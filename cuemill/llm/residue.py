"""Template residue, filler, error pages and script notices.

Character n-gram models (orders 4, 2 and 1, Witten-Bell style back-off over hashed counts) of natural prose, filler,
error notices and unfilled fields are counted over all documents, whole, and over seed texts. Each character of each document then gets a log-likelihood ratio per class; windows whose mean
ratio is high localise the residue, and the share of a sentence that such windows cover decides. Delimiters give the
extent of a possible field, as a full stop does that of a sentence; whether it is one, its ratio decides.

Defined results: a null or empty text has no residue; equal texts get equal results; a very long text is scored in
one vectorised pass without being cut; columns besides the key and the text are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, spread

PROSE, FILLER, ERROR, FIELD = range(4)
KINDS = ("prose", "filler", "error", "field")

#: The words of the customary Latin filler text.
LATIN_FILLER = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua "
    "enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in "
    "reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt "
    "culpa qui officia deserunt mollit anim id est laborum"
).split()

#: Customary filler sentences.
FILLER_SEEDS = """Your text goes here. Replace this sample paragraph with the synopsis.
This is placeholder text. This is placeholder text for the plot section. Coming soon: content to be added by an editor.
Sample description. Sample description. Sample text / sample text / sample text. Insert your content here. Dummy text dummy text. content here content here content here / content here
blah blah blah, blah, blah, blah, bla bla bla, bla, bla / bla / bla asdf asdf asdf, asdf, asdf / asdf xxxx xxxx xxxx, xxxx, xxxx / xxxx xxx xxx xxx, xxx, xxx ххх ххх ххх, ххх, ххх 内容待定内容待定内容待定
这里是占位文本，请替换为正式简介。此处内容待编辑填写，此处内容待编辑填写。本段只是示例文字，正式内容尚未撰写。
占位占位占位占位占位占位 示例文字示例文字示例文字 样例文本样例文本 此处为占位内容，请在此输入正文。内容待补充。
これはダミーテキストです。あらすじは後日追加されます。ここに本文が入ります。サンプル文を差し替えてください。
ダミーダミーダミーダミー サンプルテキストサンプルテキストサンプルテキスト 仮の文章です。本文は準備中です。
Ceci est un texte de remplissage. Remplacez ce texte d'exemple par le résumé. Texte d'exemple à compléter par la rédaction. Votre texte ici. Contenu à venir.
Dies ist ein Blindtext. Das hier ist ein Platzhalter für den Text der Handlung. Hier steht ein Beispieltext. Hier steht später die Handlung, bitte diesen Text ersetzen. Bitte ersetzen Sie diesen Mustertext. Inhalt folgt.
Este es un texto de ejemplo. Texto de relleno, reemplácelo por la sinopsis. Aquí va el texto de la trama. Contenido pendiente de completar por el editor.
Texto de exemplo a ser completado pelo editor. Este é um texto de preenchimento, substitua pela sinopse. O seu texto aqui. Conteúdo em breve.
Здесь будет текст описания, замените этот образец. Это текст-заполнитель для раздела «Сюжет». Пример текста, который нужно заменить. Текст-рыба. Содержание появится позже.""".split("\n")

#: Customary error pages and script notices.
ERROR_SEEDS = """404 Not Found. 403 Forbidden. 500 Internal Server Error. 502 Bad Gateway. 503 Service Unavailable. 504 Gateway Timeout. HTTP 404. HTTP 500. HTTP 503. Error 404. Error 500. Oops! Something went wrong. Access denied.
The page you requested could not be found. You do not have permission to open this resource. Your request was blocked by our firewall. The server did not respond in time. The upstream host sent an invalid reply. An unexpected condition was met while handling the request.
Contact the administrator if this persists. Go back to the home page. Request ID: 74fff01b. Reference #a9c400fb. Retry after 23 seconds. We are down for maintenance. Unusual traffic was detected from your network. Please sign in to continue. Home | Films | Login
Please try again later. This entry has been removed or renamed. Too many requests came from your address. Retry after 60 seconds. The service is temporarily unavailable. This content is no longer available. Session expired.
服务器繁忙，暂时无法处理请求。该内容可能已被删除。没有权限查看该条目。系统提示。抱歉。23秒后重试。访问被拒绝。请返回首页。网关超时。
ただいまサーバーが混み合っています。サーバーエラー。リクエスト番号74fff01b。60秒後に再試行してください。この項目は削除された可能性があります。アクセスが集中しています。
Le service est temporairement indisponible. Référence 74fff01b. Ce contenu a peut-être été supprimé. Trop de requêtes. Délai dépassé. Der Dienst ist vorübergehend nicht verfügbar. Dieser Eintrag wurde gelöscht oder umbenannt. Zu viele Anfragen. Zeitüberschreitung.
El servicio no está disponible temporalmente. Vuelva a la página de inicio. Referencia 74fff01b. Demasiadas solicitudes. O serviço está temporariamente indisponível. Referência 74fff01b. Demasiados pedidos. Este conteúdo foi removido. Сервис временно недоступен. Код запроса 74fff01b. Слишком много запросов. Запись удалена. Разрешите JavaScript, чтобы просмотреть эту страницу.
Please enable JavaScript and cookies, then reload. Activate JavaScript to view this page. You need to turn on scripting support in your browser settings. Your browser has disabled scripts. This site does not work without JavaScript and cookies. To continue, allow scripts, then reload.
页面不存在。您访问的页面找不到了。服务器内部错误。拒绝访问。您没有权限查看此页面。网站正在维护中。检测到来自您网络的异常请求。请求编号：74fff01b。请登录后再访问。请稍后再试。返回首页。服务器没有及时响应。错误 404。
请开启 JavaScript 和 Cookie，然后刷新页面。请在浏览器中允许脚本才能正常显示。本站需要启用脚本。您的浏览器已禁用 JavaScript。
ページが見つかりません。お探しのページは見つかりませんでした。このページを表示する権限がありません。サーバー内部エラー。ただいまメンテナンス中です。しばらくしてからもう一度お試しください。トップページへ戻る。アクセスが拒否されました。エラー 404。
このページを表示するにはJavaScriptとCookieを有効にしてください。お使いのブラウザではスクリプトが無効になっています。スクリプトを許可してください。
Page introuvable. La page demandée est introuvable. Accès refusé. Erreur interne du serveur. Erreur 404. Vous n'avez pas l'autorisation d'afficher cette page. Le site est en maintenance. Réessayez plus tard. Retour à l'accueil. Le serveur n'a pas répondu à temps.
Veuillez activer JavaScript et les cookies dans votre navigateur. Autorisez JavaScript et les cookies pour afficher cette page. Votre navigateur bloque les scripts. Ce site nécessite JavaScript.
Seite nicht gefunden. Die angeforderte Seite wurde nicht gefunden. Zugriff verweigert. Interner Serverfehler. Fehler 404. Vorgangsnummer 74fff01b. Der Server hat nicht rechtzeitig geantwortet. Wartungsarbeiten. Bitte versuchen Sie es später erneut. Zurück zur Startseite. Sie haben keine Berechtigung.
Bitte aktivieren Sie JavaScript und Cookies in Ihrem Browser. Bitte aktivieren Sie Skripte. Diese Seite benötigt JavaScript. Ihr Browser blockiert Skripte.
Página no encontrada. La página solicitada no existe. Acceso denegado. Error interno del servidor. Error 404. No tiene permiso para ver este recurso. El sitio está en mantenimiento. Inténtelo de nuevo más tarde. Volver al inicio. El servidor no respondió a tiempo.
Active JavaScript y las cookies en su navegador. Este sitio necesita los scripts en su navegador. Para continuar, permita JavaScript. Su navegador tiene los scripts desactivados.
Página não encontrada. A página pedida não existe. Acesso negado. Erro interno do servidor. Erro 404. Não tem permissão para ver este recurso. O site está em manutenção. Tente novamente mais tarde. Voltar ao início. O servidor não respondeu a tempo.
Ative JavaScript no navegador. Este site requer JavaScript. É preciso permitir JavaScript e cookies no navegador. O seu navegador desativou os scripts.
Страница не найдена. Запрошенная страница не найдена. Доступ запрещён. Внутренняя ошибка сервера. Ошибка 404. У вас нет прав для просмотра этой страницы. Ведутся технические работы. Повторите попытку позже. Вернуться на главную. Сервер не ответил вовремя.
Включите JavaScript и файлы cookie в браузере. Для просмотра страницы разрешите скрипты. В вашем браузере отключены скрипты. Для работы сайта нужен JavaScript.""".split("\n")

#: What captions, cast lists and plain mentions write and no template does; it counts as prose.
PROSE_SEEDS = """{\\an8}Lobema lost $5 and {\\i1}everything{\\i0} at the fair. <i>Sorry</i> <b>now</b> <u>then</u> {\\an8} {\\pos(10,20)} <font color="#ffffff">Hello</font>
⟦c3⟧ Lomora waits. ⟦c4.1⟧ Kadone does not. ⟦c12⟧ ♪ la la la ♪ [DOOR OPENS] [MUSIC] [LAUGHS] (SIGHS) [uncredited] (played by Neriko) He insists on 50%. She steps in with 100% of the money.
## Plot ## Handlung ## Intrigue ## Trama ## Enredo ## Сюжет ## 剧情 ## あらすじ [1] [2] [citation needed] [sic] 【旁白】 【音乐】 [TÜR ÖFFNET SICH] [suena el teléfono] [PORTE] [МУЗЫКА]
Nolo learns JavaScript in prison and sells the code. The script needs cookies for the kitchen scene. Tade works in room 404 and never leaves it. He runs the server room, and the error was never explained. A poster in the hall reads "Lorem ipsum", and she asks what it means.
The vault keeps repeating that access is denied, and she laughs. 他住在404号房间，从不出门。他推开门，说他学过JavaScript。他说服务器坏了，她不相信。404号室に住んでいて、外へ出ない。Он живёт в комнате 404 и никого не пускает.""".split("\n")

#: Usual names of template fields, and the ways in which templates mark a field.
FIELD_NAMES = "title name date year author director overview synopsis summary runtime provider theme description url link id first_name last_name film_name title_zh title_en release_date plot_outline table_cast input_repo_name company email address price user subject content body section image".split()
FIELD_FORMS = ("{{%s}}", "{{ %s }}", "{%s}", "${%s}", "[[%s]]", "<%%= %s %%>", "%%(%s)s", "%%%s%%", "@@%s@@", "__%s__", "[INSERT %s HERE]", "<INSERT %s HERE>", "[TODO: add %s]", "<TODO: add %s>", "[TBD %s]", "<TBD %s>", "[%s goes here]", "<%s goes here>")
FIELD_WORDS = "[待填：片名] <待填：简介> [此处填写年份] <此处填写片名> 【待补充】 [ここにタイトルを入力] 【要入力：年】 <ここに説明を入力> [insérer le titre ici] [à compléter] [hier Titel einfügen] [Titel eintragen] [insertar título aquí] [por completar] [inserir título aqui] [a preencher] [вставьте название] [указать год] <сюда название>".split(" ")

#: A delimited piece that could be a field. Caption markup ({\an8}, <i>, cue markers) is not of this shape.
DELIMITED = re.compile(
    r"\{\{[^{}\n]{1,60}\}\}|\$\{[^{}\n]{1,60}\}|\{[^\W\d][\w .-]{1,40}\}|<%=?[^%\n]{1,60}%>|\[\[[^\[\]\n]{1,60}\]\]|%\([^()\n]{1,40}\)[sdif]"
    r"|%[^\W\d]\w{2,40}%|@@\w[\w .-]{0,40}@@|(?<!\w)__[^\W_][\w .-]{0,40}?__(?!\w)|\[[^\[\]\n]{2,60}\]|<[^<>/\n]{4,60}>|【[^【】\n]{2,40}】"
)
#: Pieces of which prose can't tell anything before their class is known: they are no part of the prose that is fitted.
OPEN = re.compile(r"\{\{[^{}\n]{1,60}\}\}|\$\{[^{}\n]{1,60}\}|\{[^\W\d][\w .-]{1,40}\}|<%=?[^%\n]{1,60}%>|\[\[[^\[\]\n]{1,60}\]\]|%\([^()\n]{1,40}\)[sdif]|%[^\W\d]\w{2,40}%|@@\w[\w .-]{0,40}@@|(?<!\w)__[^\W_][\w .-]{0,40}?__(?!\w)")
PIECE = re.compile(r"[^.!?。！？\n]*(?:[.!?。！？]+[\"'”’»」』)\]]*|\n|$)")


@dataclass
class ResidueModel:
    """Hashed counts of each class, by order: arrays of shape (2**bits, classes)."""

    bits: int
    counts: dict[int, np.ndarray]
    totals: np.ndarray
    alphabet: int = 20_000

    def ratios(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood ratio to prose of each character under the other classes, and whether the class has its 4-gram, each of shape (n, 3)."""
        h1, h2, h3, h4 = hashes(codes, self.bits)
        weak, strong = 0.5, 2.0
        p = (self.counts[1][h1] + weak / 10) / (self.totals + weak * self.alphabet / 10)
        context = np.empty_like(h1)
        context[1:], context[:1] = h1[:-1], 0
        p = (self.counts[2][h2] + strong * p) / (self.counts[1][context] + strong)
        context = np.empty_like(h3)
        context[1:], context[:1] = h3[:-1], 0
        p = (self.counts[4][h4] + strong * p) / (self.counts[3][context] + strong)
        logs = np.log(p)
        return np.clip(logs[:, 1:] - logs[:, :1], -8, 8), self.counts[4][h4][:, 1:] > 0


def hashes(codes: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """Hashes of the 1-, 2-, 3- and 4-grams that end at each character (texts start with three line feeds)."""
    mask = np.uint64((1 << bits) - 1)
    c = codes.astype(np.uint64)
    multiplier = np.uint64(0x9E3779B97F4A7C15)
    out, rolling = [], np.zeros_like(c)
    for lag in range(4):
        shifted = c if lag == 0 else np.concatenate([np.full(lag, 10, np.uint64), c[:-lag]])[: len(c)]
        rolling = (rolling * np.uint64(0x100000001B3)) ^ (shifted + np.uint64(lag + 1))
        out.append((((rolling * multiplier) >> np.uint64(64 - bits)) & mask).astype(np.int64))
    return tuple(out)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32) if len(text.lower()) == len(text) else np.array([ord(x.lower()[:1]) for x in text], np.uint32)


def seeds() -> dict[int, list[str]]:
    random = np.random.default_rng(0)
    latin = [" ".join(["Lorem ipsum dolor sit amet", *random.choice(LATIN_FILLER, 20)]) + "." for _ in range(60)]
    names = [*FIELD_NAMES, *(x.replace("_", " ") for x in FIELD_NAMES if "_" in x)]
    # any identifier may stand in a field: made-up ones of one and two parts
    letters = list("abcdefghijklmnopqrstuvwxyz")
    names += ["_".join("".join(random.choice(letters, random.integers(3, 9))) for _ in range(1 + k % 2)) for k in range(80)]
    # a field stands alone on its line, between spaces, or within brackets and quotes
    around = (("", ""), (" ", " "), ("(", ")"), ('"', '"'))
    fields = [a + form % name + b for k, (form, name) in enumerate(itertools.product(FIELD_FORMS, names)) for a, b in (around[0], around[1 + k % 3])]
    return {FILLER: FILLER_SEEDS * 3 + latin, ERROR: ERROR_SEEDS * 3, FIELD: fields + FIELD_WORDS * 6}


ORDERS = (1, 2, 3, 4)


def counted(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """By order and hash how often the n-grams stand in the texts, and how many of the texts hold them. A text counts alone, with a line feed behind it, so that counts of parts add up to those of the whole."""
    often, held = np.zeros((len(ORDERS), 1 << bits)), np.zeros((len(ORDERS), 1 << bits))
    if not texts:
        return often, held
    joined = code_points("\n\n\n".join(["", *texts, ""]))
    # three line feeds stand before each text; the first of those behind it is its own
    owner = np.concatenate([[-1] * 3, np.repeat(np.arange(len(texts)), np.array([len(x) + 3 for x in texts]))])
    ends = 3 + np.cumsum([len(x) + 3 for x in texts])
    owner[ends - 1] = owner[ends - 2] = -1
    inside = owner >= 0
    for k, h in enumerate(hashes(joined, bits)):
        h = h[inside]
        often[k] = np.bincount(h, minlength=1 << bits)
        held[k] = np.bincount(np.unique(owner[inside] * (1 << bits) + h) & ((1 << bits) - 1), minlength=1 << bits)
    return often, held


def modelled(often: dict[int, np.ndarray], held: np.ndarray, documents: float, bits: int, common: float = 0.002) -> ResidueModel:
    """The model of counted n-grams (order, hash) of each class. Prose keeps those that at least the share ``common`` of its
    documents hold: residue that the documents still contain is rarer than that, and would else count as prose."""
    counts = {order: np.zeros((1 << bits, 4), np.float32) for order in ORDERS}
    for kind, own in often.items():
        for k, order in enumerate(ORDERS):
            counts[order][:, kind] = own[k]
            if kind == PROSE:
                counts[order][held[k] < common * documents, kind] = 0
                for own_seed in PROSE_SEEDS:
                    counts[order][:, kind] += 5 * np.bincount(hashes(code_points(own_seed), bits)[order - 1], minlength=1 << bits)
    return ResidueModel(bits, counts, counts[1].sum(0, dtype=np.float64).astype(np.float32))


def fit_counts(texts: dict[int, list[str]], bits: int, common: float = 0.002) -> ResidueModel:
    """The model of the texts of each class."""
    found = {kind: counted(own, bits) for kind, own in texts.items()}
    return modelled({kind: x[0] for kind, x in found.items()}, found[PROSE][1], len(texts[PROSE]), bits, common)


def find_spans(texts: list[str], model: ResidueModel, window: int = 24, high: float = 0.8, cover: float = 0.7, least: float = 14.0, support: float = 0.4, field: float = 2.5) -> list[list[tuple[int, int, str]]]:
    """Of each text the spans (begin, end, kind) of residue, in code points."""
    codes = code_points("\n\n\n".join(["", *texts]))
    if not len(codes):
        return [[] for _ in texts]
    ratios, held = model.ratios(codes)
    known = np.vstack([np.zeros((1, 3), np.int64), np.cumsum(held, 0, dtype=np.int64)])
    total = np.vstack([np.zeros((1, 3), np.float32), np.cumsum(ratios, 0, dtype=np.float64)])
    found, base = [], 3
    for text in texts:
        spans = []
        for kind in (FILLER, ERROR):
            sums = total[base : base + len(text) + 1, kind - 1]
            # where no stretch of the text reaches the least sum of any piece, which has four characters, none needs a look
            if len(text) < 4 or np.max(sums - np.minimum.accumulate(sums)) < min(least, high * 4):
                continue
            for m in PIECE.finditer(text):
                begin, end = m.start(), m.end()
                while begin < end and text[begin].isspace():
                    begin += 1
                while end > begin and text[end - 1].isspace():
                    end -= 1
                n = end - begin
                if n < 4 or sums[end] - sums[begin] < min(least, high * n) or known[base + end, kind - 1] - known[base + begin, kind - 1] < support * n:
                    continue
                w = min(window, n)
                hot = np.flatnonzero(sums[begin + w : end + 1] - sums[begin : end + 1 - w] >= high * w)
                edges = np.zeros(n + 1, np.int32)
                np.add.at(edges, hot, 1)
                np.add.at(edges, hot + w, -1)
                if np.count_nonzero(np.cumsum(edges)[:n]) >= cover * n and any(x.isalpha() for x in text[begin:end]):
                    spans.append((begin, end, KINDS[kind]))
        if re.search(r"[{\[<%@_【]", text):
            sums = total[base : base + len(text) + 1, FIELD - 1]
            for m in DELIMITED.finditer(text):
                begin, end = m.span()
                if sums[end] - sums[begin] >= field:
                    spans.append((begin, end, KINDS[FIELD]))
        found.append(sorted(spans))
        base += len(text) + 3
    return found


def parted(texts: list[str], model: ResidueModel | None) -> tuple[list[str], dict[int, list[str]]]:
    """The texts without what may be a field and what the model finds, and the pieces that it finds, by class."""
    moved: dict[int, list[str]] = {FILLER: [], ERROR: [], FIELD: []}
    if model is None:
        return [OPEN.sub(" ", x) for x in texts], moved
    clean = []
    for own, spans in zip(texts, find_spans(texts, model)):
        last, kept = 0, []
        for begin, end, kind in spans:
            if begin < last:
                continue
            kept.append(own[last:begin])
            moved[KINDS.index(kind)].append(own[begin:end])
            last = end
        clean.append(OPEN.sub(" ", "".join([*kept, own[last:]])))
    return clean, moved


def tallied(frames, model: ResidueModel | None, bits: int):
    """One frame of rows (kind, place of the order, hash, n, held) for all texts (column t); kind -1 has the number of texts."""
    often, held, documents = {kind: np.zeros((len(ORDERS), 1 << bits)) for kind in range(4)}, np.zeros((len(ORDERS), 1 << bits)), 0
    for frame in batches(frames, 400):
        texts = frame["t"].tolist()
        documents += len(texts)
        clean, moved = parted(texts, model)
        own = counted(clean, bits)
        often[PROSE] += own[0]
        held += own[1]
        for kind, pieces in moved.items():
            if pieces:
                often[kind] += counted(pieces, bits)[0]
    out = [pd.DataFrame({"kind": [-1], "level": [0], "h": [0], "n": [float(documents)], "held": [0.0]})]
    for kind, own in often.items():
        level, h = np.nonzero(own)
        out.append(pd.DataFrame({"kind": kind, "level": level, "h": h, "n": own[level, h], "held": held[level, h] if kind == PROSE else 0.0}))
    yield pd.concat(out)


def from_tallies(rows: pd.DataFrame, bits: int) -> ResidueModel:
    """The model of the summed rows of tallied() and of the seeds."""
    often = {PROSE: np.zeros((len(ORDERS), 1 << bits))} | {kind: counted(own, bits)[0] for kind, own in seeds().items()}
    held = np.zeros((len(ORDERS), 1 << bits))
    for kind, own in often.items():
        part = rows[rows["kind"] == kind]
        at = part["level"].to_numpy(np.int64), part["h"].to_numpy(np.int64)
        own[at] += part["n"].to_numpy()
        if kind == PROSE:
            held[at] = part["held"]
    return modelled(often, held, float(rows.loc[rows["kind"] == -1, "n"].sum()), bits)


def fit(documents: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 18, rounds: int = 2) -> ResidueModel:
    """Fits the models on all documents, whole, and the seeds. The documents are counted where they lie; to the driver come counts by hash, whatever the size.

    Each further round moves what the model of the last round found from prose to the class that it belongs to."""
    rows = spread(documents.where(F.length(text) > 0).select(F.col(text).alias("t")))
    model = None
    for _ in range(rounds + 1):
        shared = documents.sparkSession.sparkContext.broadcast(model)
        found = rows.mapInPandas(lambda frames, shared=shared: tallied(frames, shared.value, bits), "kind int, level int, h int, n double, held double")
        model = from_tallies(found.groupBy("kind", "level", "h").agg(F.sum("n").alias("n"), F.sum("held").alias("held")).toPandas(), bits)
    return model


def residue_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", model: ResidueModel | None = None) -> DataFrame:
    """One row per residue span: key, begin, end (code points, end excluded), kind, and the share of the text that all residue covers."""
    model = model or fit(documents, key, text)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind_of_key = documents.schema[key].dataType.simpleString()

    def scan(frames):
        for frame in batches(frames, 400):
            texts = frame["t"].tolist()
            out = []
            for k, own, spans in zip(frame["k"].tolist(), texts, find_spans(texts, shared.value)):
                share = sum(e - b for b, e, _ in spans) / max(1, len(own))
                out += [(k, b, e, kind, min(1.0, share)) for b, e, kind in spans]
            if out:
                yield pd.DataFrame(out, columns=[key, "begin", "end", "kind", "share"])

    rows = spread(documents.where(F.length(text) > 0).select(F.col(key).alias("k"), F.col(text).alias("t")))
    return rows.mapInPandas(scan, f"{key} {kind_of_key}, begin int, end int, kind string, share double")


def residue_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", model: ResidueModel | None = None) -> DataFrame:
    """One row per document with residue: key, spans by kind, share covered, and whether what is left is worth keeping."""
    spans = residue_spans(documents, key, text, model)
    return spans.groupBy(key).agg(
        F.max("share").alias("share"),
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"{k}_spans") for k in KINDS[1:]],
        (F.max("share") >= 0.5).alias("exclude"),
    )
