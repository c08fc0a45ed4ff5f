"""Personal data replaced by keyed surrogates of the same type, script, gender and format."""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.rows import own_columns, spare_names
from skyledger.llm.textbytes import chunks_of
from skyledger.session import materialise, send_code_with_tasks

send_code_with_tasks(__name__)

#: Entities on their second or later try that are sent to all tasks; more are joined.
BROADCAST_ENTITIES = 100_000

# Fixed values of the surrogates: given names by script and gender (n: not told), family
# names by script, and syllables for further names.
GIVEN = {
    "latin:f": "Maria Anna Elena Sophie Claire Julia Laura Emma Olivia Isabel Carmen Lucia Ingrid Heike Sabine Monika "
    "Catherine Margaret Elizabeth Jennifer Jessica Susan Barbara Patricia Nathalie Camille",
    "latin:m": "John James Robert Michael William David Thomas Daniel Peter Paul Carlos Miguel Javier Alejandro Jorge "
    "Hans Klaus Stefan Wolfgang Pierre Jacques Nicolas Laurent Olivier Matthias Andreas",
    "cyrillic:f": "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия",
    "cyrillic:m": "Иван Сергей Дмитрий Александр Андрей Алексей Михаил Николай Павел Виктор",
    "greek:f": "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Αγγελική Γεωργία Δήμητρα",
    "greek:m": "Γιώργος Δημήτρης Κωνσταντίνος Νικόλαος Παναγιώτης Χρήστος Αθανάσιος Μιχάλης",
    "arabic:f": "فاطمة عائشة مريم خديجة زينب ليلى سلمى ياسمين",
    "arabic:m": "محمد أحمد محمود إبراهيم يوسف خالد عمر مصطفى",
    "devanagari:f": "सुनीता प्रिया अंजलि कविता नेहा पूजा सीमा रेखा",
    "devanagari:m": "राजेश अमित अनिल संजय सुरेश रमेश विजय महेश",
    "latin:n": "Robin Andrea Jamie Charlie Morgan Dominique Kim Sascha",
    "cyrillic:n": "Саша Женя Валя Слава",
    "greek:n": "Φώτης Βαγγέλης Χαρά Αγάπη",
    "hangul:n": "민수 지훈 서연 민준 지우 현우 수빈 유진 은지 도윤",
    "japanese:n": "太郎 花子 健一 美咲 翔太 陽子 誠 恵子",
    "katakana:n": "タロウ ハナコ ケンイチ ミサキ ショウタ ヨウコ マリア トマス",
}
FAMILY = {
    "latin": "Walker Hughes Bennett Fischer Schneider Hoffmann Moreau Lefebvre Fontaine Navarro Delgado Romero Larsen Novak Costa Rossi",
    "cyrillic": "Иванов Петров Соколов Морозов Волков Козлов Лебедев Новиков",
    "greek": "Παπαδόπουλος Νικολάου Γεωργίου Δημητρίου Αντωνίου Ιωάννου",
    "han": "王 李 张 刘 陈 杨 赵 黄 周 吴",
    "hangul": "김 이 박 최 정 강 조 윤 장 임",
    "japanese": "佐藤 鈴木 高橋 田中 伊藤 渡辺 山本 中村",
    "arabic": "المصري الهاشمي الخطيب النجار الحداد العلي",
    "devanagari": "शर्मा वर्मा गुप्ता पटेल मिश्रा जोशी",
}
HAN_GIVEN = "伟 芳 娜 敏 静 丽 强 磊 军 洋 勇 艳 杰 娟 涛 明 超 兰 霞 平"
SYLLABLES = {
    "latin": "ba be bo da de do fa fi ga go ha ka ke la le lo ma me mi na ne no pa ra re ri ro sa se ta te to va vi za",
    "cyrillic": "ба бе во га да до ка ко ла ле ма ми на но па ра ро са та то",
    "greek": "βα γα δα κα κο λα λε μα μι να νο πα ρα ρο σα τα το",
    "han": HAN_GIVEN,
    "hangul": "가 나 도 라 미 서 아 영 우 은 재 준 지 진 하 현",
    "japanese": "田 山 川 村 木 本 井 野 原 林 谷 森",
    "katakana": "ア イ カ キ サ シ タ ナ マ ミ ラ リ",
    "arabic": "با دا را سا فا كا لا ما نا يا",
    "devanagari": "का गा ता दा ना पा मा रा ला वा",
}

# Fixed values of the detector, apart from those of the surrogates: further given names,
# family names and titles by script, words in front of a name, a phone number or a secret.
MORE_GIVEN = {
    "latin:f": "Mary Linda Karen Nancy Lisa Betty Sandra Ashley Emily Michelle Amanda Melissa Deborah Stephanie Rebecca "
    "Sharon Cynthia Kathleen Amy Angela Anne Ann Alice Helen Hannah Rachel Martha Diane Ruth Sarah Samantha Katherine "
    "Charlotte Amelia Isabella Mia Chloe Zoe Lucy Ella Nora Eva Teresa Pilar Rosa Ana Marta Paula Silvia Cristina Beatriz "
    "Francesca Giulia Chiara Valentina Paola Ursula Petra Renate Brigitte Katharina Johanna Lena Marie Jeanne Françoise "
    "Sylvie Isabelle Valérie Hélène Céline Élodie Fatima Aisha Aicha Khadija Leila Layla Zainab Amina Mariam Yasmin Noor "
    "Priya Anjali Sunita Deepika Neha Pooja Lakshmi Yuki Sakura Mei Ling Astrid Freya Agnieszka Katarzyna Małgorzata "
    "Olga Natasha Svetlana Tatiana Irina Ekaterina Ayşe Zeynep Elif Ngozi Chioma",
    "latin:m": "Charles Christopher Matthew Anthony Donald Steven Andrew Kenneth Joshua Kevin Brian George Timothy Ronald "
    "Jason Edward Jeffrey Ryan Jacob Gary Eric Jonathan Stephen Larry Justin Scott Brandon Benjamin Samuel Gregory "
    "Alexander Patrick Jack Dennis Jerry Tyler Aaron Henry Oliver Harry Arthur Adam Nathan Simon Philip Martin Richard "
    "Joseph Antonio José Juan Luis Manuel Francisco Pedro Pablo Fernando Diego Sergio Rafael Marco Giovanni Giuseppe Luca "
    "Francesco Lorenzo Jürgen Uwe Dieter Heinrich Friedrich Karl Otto Fritz Lukas Felix Jean François Henri Louis Philippe "
    "Michel André Alain Marcel Mohammed Mohamed Muhammad Ahmed Ahmad Ali Omar Hassan Hussein Ibrahim Yusuf Youssef Khalid "
    "Mustafa Mehmet Abdullah Tariq Karim Rajesh Amit Sanjay Vikram Arjun Rahul Ravi Suresh Anil Hiroshi Kenji Takashi "
    "Wei Jun Lars Erik Sven Olaf Jan Piotr Krzysztof Tomasz Andrzej Ivan Sergei Dmitri Vladimir Igor Oleg Boris Kwame "
    "Chukwuemeka Emeka Oluwaseun Nguyen",
    "cyrillic:f": "Александра Алина Анастасия Валентина Вера Галина Дарья Евгения Ксения Людмила Марина Надежда Оксана "
    "Полина София Тамара Яна",
    "cyrillic:m": "Александр Антон Борис Вадим Василий Владимир Вячеслав Геннадий Денис Евгений Игорь Илья Кирилл "
    "Константин Максим Никита Олег Павел Пётр Роман Степан Юрий Тарас Богдан",
    "greek:f": "Αναστασία Άννα Ειρήνη Ευαγγελία Κωνσταντίνα Παναγιώτα Χριστίνα Κατερίνα",
    "greek:m": "Αλέξανδρος Ανδρέας Βασίλης Γεώργιος Γιάννης Ιωάννης Κώστας Νίκος Σπύρος Στέφανος",
    "arabic:f": "آمنة هدى نورة سارة رقية",
    "arabic:m": "عبدالله عبدالرحمن حسين طارق سعيد مصطفى",
    "devanagari:f": "लक्ष्मी सरिता गीता दीपिका अनीता",
    "devanagari:m": "राहुल दिनेश मुकेश अजय विकास मोहन",
}
HAN_FAMILY = (
    "欧阳 司马 诸葛 上官 王 李 张 張 刘 劉 陈 陳 杨 楊 赵 趙 黄 黃 周 吴 吳 徐 孙 孫 胡 朱 高 林 何 郭 马 馬 罗 羅 梁 宋 郑 鄭 谢 謝 "
    "韩 韓 唐 冯 馮 于 董 萧 肖 程 曹 袁 邓 鄧 许 許 傅 沈 曾 彭 吕 呂 苏 蘇 卢 盧 蒋 蔣 蔡 贾 丁 魏 薛 叶 葉 阎 余 潘 杜 戴 夏 钟 鍾 "
    "汪 田 任 姜 范 方 石 姚 谭 廖 邹 熊 金 陆 陸 郝 孔 白 崔 康 毛 邱 秦 江 史 顾 侯 邵 孟 龙 万 段 雷 钱 汤 尹 黎 易 常 武 乔 贺 赖 龚 文"
)
HANGUL_FAMILY = "김이박최정강조윤장임한오서신권황안송전홍유고문양손배백허남심노하곽성차주우구나민진지엄채원천방공현함변염여추도소석선"
JAPANESE_FAMILY = (
    "佐々木 長谷川 佐藤 鈴木 高橋 田中 伊藤 渡辺 渡邊 山本 中村 小林 加藤 吉田 山田 山口 松本 井上 木村 斎藤 斉藤 清水 山崎 池田 橋本 "
    "阿部 石川 山下 中島 石井 小川 前田 岡田 藤田 後藤 近藤 村上 遠藤 青木 坂本 福田 太田 西村 藤井 岡本 三浦 金子 中野 原田 松田 竹内"
)
ARABIC_FAMILY = "حسن حسين علي عمر صالح ناصر سالم منصور حداد خوري نجار سليمان عثمان"
DEVANAGARI_FAMILY = "शर्मा वर्मा गुप्ता पटेल मिश्रा जोशी सिंह कुमार यादव चौधरी अग्रवाल कुमारी देवी रेड्डी नायर खान"
TITLES = (
    "Mr Mrs Ms Miss Mx Dr Prof Professor Sir Lady Herr Herrn Frau Señor Señora Señorita Sr Sra Don Doña Monsieur Madame "
    "Mademoiselle Mme Mlle Docteur Signor Signora Senhor Senhora господин госпожа гражданин гражданка κύριος κυρία κύριε"
).split()
NAME_WORDS = (
    "[Mm]y name is|[Ff]ull [Nn]ame:|[Nn]ame:|[Ii]ch heiße|[Mm]ein Name ist|[Jj]e m['’]appelle|[Mm]e llamo|[Mm]i nombre es|"
    "[Nn]ombre:|[Nn]om:|[Мм]еня зовут|[Ии]мя:|[ΜΜμ]ε λένε|[ΟΌό]νομα:"
)
HAN_TITLES = {"先生": "m", "女士": "f", "小姐": "f", "太太": "f"}
HAN_POSTS = "教授|医生|老师|博士|经理|同志"
PHONE_WORDS = (
    "phone|telephone|tel|mobile|cell|fax|call|whatsapp|telefon|handy|téléphone|tél|teléfono|móvil|тел|телефон|τηλ|τηλέφωνο|"
    "电话|手机|電話|전화|هاتف|फ़ोन|फोन"
)
SECRET_WORDS = (
    "token", "secret", "password", "passwd", "passphrase", "api_key", "api-key", "apikey", "access_key", "access-key",
    "auth_key", "private_key", "credential",
)
#: Signs that well-known keys begin with, and what follows; the signs stay.
KEY_FORMS = (
    ("AKIA|ASIA", "[0-9A-Z]{16}"), ("gh[pousr]_", "[A-Za-z0-9]{30,}"), ("github_pat_", "[A-Za-z0-9_]{22,}"),
    ("glpat-", "[A-Za-z0-9_-]{20,}"), ("xox[abeoprs]-", "[A-Za-z0-9-]{10,}"), ("AIza", "[A-Za-z0-9_-]{35}"),
    ("sk-|(?:sk|rk|pk)_(?:live|test)_", "[A-Za-z0-9_-]{20,}"), ("npm_|hf_", "[A-Za-z0-9]{30,}"),
    ("eyJ", r"[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", "[A-Za-z0-9+/=\\s]{40,}"),
)

GIVEN_KIND = {
    name: kind for table in (MORE_GIVEN, GIVEN) for kind, names in table.items() if kind[-1] != "n" for name in names.split()
}

UPPER, ANY = r"A-ZÀ-Þ\u0386-\u03ABА-ЯЁ", r"[^\W\d_]"
# The patterns run over whole texts begin with a set of signs, by which the engine skips
# ahead; what stands in front of a match is looked at afterwards.
NAME = rf"[{UPPER}](?:{ANY}|['’-](?={ANY}))+(?!\w)"
PERSON = re.compile(rf"([{UPPER}]{ANY}+)(?=(?: [{UPPER}]\.)? ({NAME}))")
TITLED = re.compile(rf"({'|'.join(TITLES)})\.? (?=({NAME})(?: ({NAME}))?)")
# One of these is in every text that CALLED finds something in.
CALLED_SIGNS = (
    "y name is", "ame:", "ch heiße", "ein Name ist", "m'appelle", "m’appelle", "e llamo", "i nombre es", "ombre:", "om:",
    "еня зовут", "мя:", "ε λένε", "νομα:",
)
CALLED = re.compile(rf"(?:{NAME_WORDS}) ?(?=({NAME})(?: ({NAME}))?)")
HAN_PERSON = re.compile(
    rf"({HAN_FAMILY.replace(' ', '|')})(?:([\u4e00-\u9fff]{{0,2}}?)({'|'.join(HAN_TITLES)})|([\u4e00-\u9fff]{{1,2}}?)(?:{HAN_POSTS}))"
)
HAN_CALLED = re.compile(rf"(?:我叫|名叫|姓名[:：] ?)({HAN_FAMILY.replace(' ', '|')})([\u4e00-\u9fff]{{1,2}})(?![\u4e00-\u9fff])")
HANGUL_PERSON = re.compile(rf"(?<![가-힣])([{HANGUL_FAMILY}])([가-힣]{{1,2}})(?= ?(?:씨(?!앗)|님|선생님|교수님|박사님))")
JAPANESE_PERSON = re.compile(
    rf"({JAPANESE_FAMILY.replace(' ', '|')})[ 　]?([\u4e00-\u9fff々ぁ-ん]{{0,3}}?)(?=さん|様|氏|くん|君|ちゃん)"
)
KATAKANA_PERSON = re.compile("(?<![ァ-ヺー])([ァ-ヺー]{2,10})(?=さん|様|氏|くん|ちゃん)")
UNCASED = re.compile("[\u0600-\u06FF\u0900-\u097F\u3040-\u30FF\u4E00-\u9FFF\uAC00-\uD7A3]")
ARABIC, DEVANAGARI = "[\u0621-\u065F\u0670-\u06D3]", "[\u0900-\u0963\u0970-\u097F]"
ARABIC_TITLED = re.compile(rf"(?<!\w)(?:السيدة|السيد|الدكتورة|الدكتور|الأستاذة|الأستاذ|اسمي) ({ARABIC}+)(?: ({ARABIC}+))?")
ARABIC_PERSON = re.compile(rf"(?<!\w)({'|'.join(sorted((k for k, v in GIVEN_KIND.items() if v[:3] == 'ara'), key=len, reverse=True))})(?: (?:بن |ابن |بنت )?({ARABIC}+))?(?!{ARABIC})")
DEVANAGARI_PERSON = re.compile(
    rf"(?<!{DEVANAGARI})(?:(?:श्रीमती|श्री|सुश्री|डॉ\.?|डॉक्टर|मेरा नाम) )?({DEVANAGARI}+)(?: ({DEVANAGARI}+))?"
)
DEVANAGARI_TITLE = re.compile("(?:श्रीमती|श्री|सुश्री|डॉ|मेरा नाम)")
DIGIT = re.compile("[0-9]")
RUN = re.compile(r"[0-9+(][0-9(). /+-]{5,}")
NUMBER = re.compile(
    r"(?<![\w.@-])(?:"
    r"(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?!\.?[0-9])"
    r"|(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?!-?[0-9])"
    r"|(?P<card>[0-9](?:[ -]?[0-9]){12,18})(?![ -]?[0-9])"
    r"|(?P<phone>\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,5}"
    r"|(?:1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|(?:1[ .-])?[0-9]{3}(?P<sep>[ .-])[0-9]{3}(?P=sep)[0-9]{4}"
    r"|0[0-9](?:[ .-][0-9]{2}){4}|\(?0[0-9]{1,4}\)?[ /-][0-9]{3,8}(?:[ -][0-9]{2,5}){0,2}"
    r"|[67][0-9]{2}(?: [0-9]{2}){3}|1[3-9][0-9](?:[ -]?[0-9]{4}){2}"
    r"|8[ -]?\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{2}[ -][0-9]{2})(?!-?[0-9])"
    r")(?!\w)"
)
PHONE_WORD = re.compile(rf"(?:{PHONE_WORDS})[a-z]*\.?\s*[:：]?\s*$", re.IGNORECASE)
PHONE = re.compile(r"\+?\(?[0-9](?:[ ()./-]{0,2}[0-9]){6,14}(?![0-9]|\.[0-9])")
KEY = re.compile("(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{a})(?={b})" for a, b in KEY_FORMS) + ")")
KEY_BODIES = [(re.compile(a), re.compile(b)) for a, b in KEY_FORMS]
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
SECRET = re.compile("|".join(SECRET_WORDS), re.IGNORECASE)
VALUE = re.compile(r"[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9+/_-]{8,})")
LOCAL, DOMAIN = re.compile(r"[A-Za-z0-9._%+-]{1,64}$"), re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}")
HEX = re.compile(r"[0-9a-fA-F]+$")

Entity = tuple[int, int, str, str]


def luhn_ok(digits: str) -> bool:
    doubled = (int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def iban_ok(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def script_of(name: str) -> str:
    first = ord(name[0])
    return (
        "greek" if 0x370 <= first < 0x400 else "cyrillic" if 0x400 <= first < 0x530 else "arabic" if 0x600 <= first < 0x700
        else "devanagari" if 0x900 <= first < 0x980 else "latin"
    )


def family_name(name: str) -> tuple[str, str]:
    """Kind and canonical form; a Cyrillic name's feminine ending is left to the mention."""
    script = script_of(name)
    return f"family:{script}", name.removesuffix("а") if script == "cyrillic" else name


def _numbers(text: str) -> Iterator[Entity]:
    matches = {}
    for run in RUN.finditer(text):
        for m in NUMBER.finditer(text, run.start()):
            if m.start() >= run.end():
                break
            matches[m.start()] = m
    for m in matches.values():
        kind = next(k for k in ("ip", "ssn", "card", "phone") if m[k])
        found = m[kind]
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            parts = [int(x) for x in found.split(".")]
            if max(parts) < 256:
                yield m.start(), m.end(), "ip", ".".join(map(str, parts))
        elif kind == "card":
            # Other long numbers are no cards; those of an issuer carry a check digit.
            if digits[0] in "23456" and luhn_ok(digits):
                yield m.start(), m.end(), "card", digits
        elif kind == "ssn" or 8 <= len(digits) <= 15:
            yield m.start(), m.end(), kind, digits


def _starts_word(text: str, start: int) -> bool:
    return not start or not (text[start - 1].isalnum() or text[start - 1] == "_")


def _mails(text: str) -> Iterator[Entity]:
    at = text.find("@")
    while at >= 0:
        left, right = LOCAL.search(text[max(0, at - 64) : at]), DOMAIN.match(text, at + 1)
        if left and right:
            yield at - len(left[0]), right.end(), "email", f"{left[0]}@{right[0]}".lower()
        at = text.find("@", at + 1)


def _phones(text: str) -> Iterator[Entity]:
    """Digits behind a word such as ``phone``, in any grouping."""
    for run in RUN.finditer(text):
        before = text[max(0, run.start() - 24) : run.start()]
        word, number = PHONE_WORD.search(before), PHONE.match(text, run.start())
        if word and number and (_starts_word(before, word.start()) or not word[0][0].isascii()):
            yield run.start(), number.end(), "phone", re.sub("[^0-9]", "", number[0])


def _codes(text: str) -> Iterator[Entity]:
    for m in KEY.finditer(text):
        body = next(b for b in (b.match(text, m.end()) for a, b in KEY_BODIES if a.fullmatch(m[0])) if b)
        yield m.end(), body.end(), "secret", body[0].lower() if HEX.match(body[0]) else body[0]
    if "=" in text or ":" in text:
        for m in SECRET.finditer(text):
            value = VALUE.match(text, m.end())
            if value and DIGIT.search(value[1]) and not KEY.match(text, value.start(1)):
                yield value.start(1), value.end(1), "secret", value[1].lower() if HEX.match(value[1]) else value[1]
    for m in IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if _starts_word(text, m.start()) and iban_ok(code):
            yield m.start(), m.end(), "iban", code


def _persons(text: str) -> Iterator[Entity]:
    """Names told by a known given name, a title or words such as ``my name is``, and later
    mentions of the same names."""
    names: dict[str, tuple[str, str]] = {}
    spans = []
    for m in PERSON.finditer(text):
        kind = GIVEN_KIND.get(m[1])
        if kind and _starts_word(text, m.start()):
            names[m[1]], names[m[2]] = (f"given:{kind}", m[1]), family_name(m[2])
            spans += [(m.start(1), m.end(1), *names[m[1]]), (m.start(2), m.end(2), *names[m[2]])]
    for m in TITLED.finditer(text):
        if m[2] not in GIVEN_KIND and _starts_word(text, m.start()):
            names.setdefault(m[2], family_name(m[2]))
            spans.append((m.start(2), m.end(2), *names[m[2]]))
            if m[3]:
                spans.append((m.start(3), m.end(3), *names.get(m[3], family_name(m[3]))))
    for m in CALLED.finditer(text) if any(sign in text for sign in CALLED_SIGNS) else ():
        if _starts_word(text, m.start()):
            kind = GIVEN_KIND.get(m[1], f"{script_of(m[1])}:n")
            names.setdefault(m[1], (f"given:{kind}", m[1]))
            spans.append((m.start(1), m.end(1), *names[m[1]]))
            if m[2]:
                names.setdefault(m[2], family_name(m[2]))
                spans.append((m.start(2), m.end(2), *names[m[2]]))
    if not text.isascii() and UNCASED.search(text):
        spans += _uncased_persons(text, names)
    for name, entity in names.items():
        edge = {"arabic": ARABIC, "devanagari": DEVANAGARI}.get(script_of(name), r"\w")
        spans += [(m.start(), m.end(), *entity) for m in re.finditer(rf"(?<!{edge}){re.escape(name)}(?!{edge})", text)]
    yield from spans


def _uncased_persons(text: str, names: dict[str, tuple[str, str]]) -> Iterator[Entity]:
    """Names of scripts without capitals. Arabic and Devanagari ones are added to ``names``."""
    def pair(m, script, gender="n", given=2):
        yield m.start(1), m.end(1), f"family:{script}", m[1]
        if m[given]:
            yield m.start(given), m.end(given), f"given:{script}:{gender}", m[given]

    for m in HAN_PERSON.finditer(text):
        yield from pair(m, "han", HAN_TITLES[m[3]]) if m[3] else pair(m, "han", given=4)
    for m in HAN_CALLED.finditer(text):
        yield from pair(m, "han")
    for m in HANGUL_PERSON.finditer(text):
        yield from pair(m, "hangul")
    for m in JAPANESE_PERSON.finditer(text):
        yield from pair(m, "japanese")
    for m in KATAKANA_PERSON.finditer(text):
        yield m.start(1), m.end(1), "given:katakana:n", m[1]
    for m in ARABIC_TITLED.finditer(text):
        names.setdefault(m[1], (f"given:{GIVEN_KIND[m[1]]}", m[1]) if m[1] in GIVEN_KIND else ("family:arabic", m[1]))
    known = set(ARABIC_FAMILY.split())
    for m in ARABIC_PERSON.finditer(text):
        names.setdefault(m[1], (f"given:{GIVEN_KIND[m[1]]}", m[1]))
        if m[2] and m[2] not in GIVEN_KIND and (m[2] in known or (m[2].startswith("ال") and m[2].endswith("ي"))):
            yield m.start(2), m.end(2), "family:arabic", m[2]
    known = set(DEVANAGARI_FAMILY.split())
    for m in DEVANAGARI_PERSON.finditer(text):
        kind = GIVEN_KIND.get(m[1])
        if kind and m[2] in known:
            names[m[1]], names[m[2]] = (f"given:{kind}", m[1]), ("family:devanagari", m[2])
        elif m.start(1) > m.start() and DEVANAGARI_TITLE.match(text, m.start()):
            names.setdefault(m[1], (f"given:{kind}", m[1]) if kind else ("family:devanagari", m[1]))
            if m[2] in known:
                names.setdefault(m[2], ("family:devanagari", m[2]))


def find_entities(text: str) -> list[Entity]:
    """``start, end, kind, canonical form`` of all entities, in order and without overlaps.

    Of overlapping ones the earliest is taken, and of those the longest.
    """
    found = {*_mails(text), *_persons(text)}
    if DIGIT.search(text):
        found |= {*_numbers(text), *_phones(text), *_codes(text)}
    found = sorted(found, key=lambda e: (e[0], -e[1], e[2]))
    kept: list[Entity] = []
    for entity in found:
        if not kept or entity[0] >= kept[-1][1]:
            kept.append(entity)
    return kept


class Draw:
    """Numbers that depend on a key, an entity and the try, and on nothing else."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{canonical}\0{attempt}".encode(), hashlib.sha256).digest()
        self.state, self.block = 0, 0

    def below(self, n: int) -> int:
        if self.state < 1 << 64:
            self.block += 1
            self.state = int.from_bytes(hashlib.sha256(self.seed + self.block.to_bytes(4, "big")).digest(), "big")
        self.state, rest = divmod(self.state, n)
        return rest

    def like(self, sign: str) -> str:
        if sign.isdigit():
            return "0123456789"[self.below(10)]
        if "a" <= sign.lower() <= "z":
            letter = "abcdefghijklmnopqrstuvwxyz"[self.below(26)]
            return letter.upper() if sign.isupper() else letter
        return sign

    def digits(self, count: int) -> str:
        return "".join("0123456789"[self.below(10)] for _ in range(count))


def _stretched(draw: Draw, text: str) -> str:
    """Letters for letters and digits for digits; a short run of letters becomes six."""
    def run(m):
        return "".join(draw.like("a") for _ in range(max(6, len(m[0])))) if m[0][0].isalpha() else "".join(map(draw.like, m[0]))

    return re.sub(r"[a-z]+|[0-9]+", run, text)


def _name(draw: Draw, kind: str, attempt: int) -> str:
    part, script, *gender = kind.split(":")
    pool = FAMILY[script] if part == "family" else HAN_GIVEN if script == "han" else GIVEN[f"{script}:{gender[0]}"]
    pool = pool.split()
    if attempt < 2:
        return pool[draw.below(len(pool))]
    syllables = SYLLABLES[script].split()
    made = "".join(syllables[draw.below(len(syllables))] for _ in range(1 + attempt // 2))
    ends = {"latin:f": "na", "latin:m": "n", "cyrillic:f": "на", "cyrillic:m": "н", "greek:f": "να", "greek:m": "νος"}
    return (made + ends.get(":".join([script, *gender]), "")).capitalize()


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The replacement of an entity in canonical form; each further attempt gives another."""
    draw = Draw(key, kind, canonical, attempt)
    if kind == "email":
        local, domain = canonical.rsplit("@", 1)
        *hosts, _, top = domain.split(".")
        by_domain = Draw(key, "domain", domain, 0)
        return f"{_stretched(draw, local)}@{'.'.join([*[_stretched(by_domain, h) for h in hosts], 'example', top])}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "card":
        body = canonical[0] + draw.digits(len(canonical) - 2)
        return next(body + d for d in "0123456789" if luhn_ok(body + d))
    if kind == "phone":
        return canonical[0] + draw.digits(len(canonical) - 1)
    if kind == "ssn":
        return f"{100 + draw.below(566)}" + f"{1 + draw.below(99):02d}" + f"{1 + draw.below(9999):04d}"
    if kind == "iban":
        body = "".join(map(draw.like, canonical[4:]))
        value = int("".join(str(int(c, 36)) for c in body + canonical[:2] + "00"))
        return f"{canonical[:2]}{98 - value % 97:02d}{body}"
    if kind == "secret":
        if HEX.match(canonical):
            return "".join(draw.digits(1) if c.isdigit() else "abcdef"[draw.below(6)] for c in canonical)
        return "".join(map(draw.like, canonical))
    return _name(draw, kind, attempt)


def rendered(kind: str, mention: str, value: str) -> str:
    """A surrogate in the format of the mention: its separators and its case."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(value)
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if kind == "iban":
        signs = iter(value)
        return "".join(c if c == " " else next(signs) for c in mention)
    if kind == "secret" and HEX.match(mention):
        return "".join(v.upper() if c.isupper() else v for c, v in zip(mention, value))
    if kind in ("email", "secret") and mention.isupper():
        return value.upper()
    if kind == "family:cyrillic" and mention.endswith("а"):
        return value + "а"
    return value


def replace_entities(text: str, key: bytes, later: dict[tuple[str, str], int]) -> tuple[str, list[str]]:
    """The text with surrogates, and the kinds replaced. ``later`` has the entities that
    do not use their first attempt."""
    parts, last, kinds = [], 0, []
    for start, end, kind, canonical in find_entities(text):
        value = surrogate(key, kind, canonical, later.get((kind, canonical), 0))
        parts += [text[last:start], rendered(kind, text[start:end], value)]
        last = end
        kinds.append(kind.split(":")[0])
    return "".join(parts) + text[last:], kinds


def corpus_entities(docs: DataFrame) -> DataFrame:
    """The different entities of all texts: ``kind, canonical``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks_of(batch, "text"):
                found = sorted({e[2:] for t in chunk.column("text").to_pylist() if t for e in find_entities(t)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], ["kind", "canonical"]
                )

    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(work, "kind string, canonical string").distinct()


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """Add the surrogate of each entity's attempt."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [surrogate(key, *row) for row in zip(*[batch.column(i).to_pylist() for i in range(3)])]
            yield batch.append_column("value", pa.array(values, pa.string()))

    return entities.select("kind", "canonical", "attempt").mapInArrow(
        work, "kind string, canonical string, attempt int, value string"
    )


def assign_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """``kind, canonical, attempt, value`` for every entity of the corpus, all values distinct.

    A value that is itself an entity of the corpus, or that another entity of its kind
    took at an earlier attempt (or, at the same one, that sorts first), is given up for
    the next attempt. Rounds go on until no value is given up; only the entities that
    gave one up change in a round.
    """
    entities = materialise(corpus_entities(docs), "entities")
    assigned = materialise(_drawn(entities.withColumn("attempt", F.lit(0)), key), "surrogates")
    real = entities.select("kind", F.col("canonical").alias("value"), F.lit(True).alias("is_real"))
    while True:
        place = F.row_number().over(Window.partitionBy("kind", "value").orderBy("attempt", "canonical"))
        judged = assigned.withColumn("place", place).join(real, ["kind", "value"], "left")
        judged = judged.withColumn("lost", (F.col("place") > 1) | F.coalesce("is_real", F.lit(False)))
        judged = materialise(judged.select("kind", "canonical", "attempt", "value", "lost"), "judged")
        again = judged.filter("lost").withColumn("attempt", F.col("attempt") + 1)
        kept = judged.filter("not lost").drop("lost")
        if again.isEmpty():
            return kept
        assigned = materialise(kept.unionByName(_drawn(again, key)), "surrogates")


def with_surrogates(
    docs: DataFrame, key: str, broadcast_entities: int = BROADCAST_ENTITIES, kinds: str | None = None
) -> DataFrame:
    """``docs`` with its text rewritten, and, if named, a column of the kinds replaced.

    Found are e-mail and IP addresses, phone, card and social security numbers, IBANs,
    secrets behind a word such as ``token =`` or with the first signs of well-known keys,
    and names told by a given name, a title or a phrase. The README says what is missed.
    Equal entities get the same surrogate in all documents, in any case or punctuation;
    different ones get different ones, and no surrogate is an entity of the corpus. Given
    and family names are replaced each for itself, so a later mention by one of them
    agrees, and relatives go on sharing a name.

    A surrogate follows from the key and the entity alone, but for the few that collided.
    These are sent to all tasks while there are at most ``broadcast_entities``; more are
    joined to the texts that hold them.

    A null text stays null and an empty one empty, without entities; equal texts become
    equal texts; other columns are kept; an empty table gives an empty table.
    """
    secret = key.encode()
    later = assign_surrogates(docs, secret).filter("attempt > 0").select("kind", "canonical", "attempt")
    later = materialise(later, "later-surrogates")
    (own,) = spare_names(docs, "later_attempts")
    sent: dict[tuple[str, str], int] = {}
    pair = "array<struct<kind: string, canonical: string, attempt: int>>"
    if later.count() <= broadcast_entities:
        sent = {(r.kind, r.canonical): r.attempt for r in later.collect()}
        rows = docs.withColumn(own, F.lit(None).cast(pair))
    else:
        rows = _with_later(docs, later, own, pair)
    shared = docs.sparkSession.sparkContext.broadcast(sent)
    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for chunk in chunks_of(batch, "text"):
                done = []
                for text, extra in zip(chunk.column("text").to_pylist(), chunk.column(own).to_pylist()):
                    more = {(e["kind"], e["canonical"]): e["attempt"] for e in extra or ()}
                    done.append(replace_entities(text, secret, {**known, **more} if more else known) if text else (text, []))
                columns = [c for c, n in zip(chunk.columns, chunk.schema.names) if n != own]
                columns[place] = pa.array([t for t, _ in done], pa.string())
                names = [n for n in chunk.schema.names if n != own]
                if kinds:
                    columns.append(pa.array([k for _, k in done], pa.list_(pa.string())))
                    names.append(kinds)
                yield pa.RecordBatch.from_arrays(columns, names)

    text = F.col("text").cast("string")
    schema = docs.withColumn("text", text).schema
    if kinds:
        schema = T.StructType([*schema.fields, T.StructField(kinds, T.ArrayType(T.StringType()))])
    return rows.withColumn("text", text).select(*own_columns(docs), own).mapInArrow(work, schema)


def _with_later(docs: DataFrame, later: DataFrame, name: str, kind: str) -> DataFrame:
    """Join to each row the entities of its text that are in ``later``, by a hash of the text.

    Attempts hold for the whole corpus, so two texts with one hash would share harmless
    entries.
    """
    (key,) = spare_names(docs, "text_key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks_of(batch, "text"):
                found = sorted({
                    (k, *e[2:]) for k, t in zip(chunk.column("key").to_pylist(), chunk.column("text").to_pylist())
                    if t for e in find_entities(t)
                })
                kinds = (pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], ["key", "kind", "canonical"]
                )

    text = F.col("text").cast("string")
    held = docs.select(F.xxhash64(text).alias("key"), text.alias("text")).mapInArrow(
        work, "key bigint, kind string, canonical string"
    ).distinct()
    lists = held.join(later, ["kind", "canonical"]).groupBy("key").agg(
        F.collect_list(F.struct("kind", "canonical", "attempt")).cast(kind).alias(name)
    )
    keyed = docs.withColumn(key, F.xxhash64(text))
    return keyed.join(lists.withColumnRenamed("key", key), key, "left").select(*own_columns(docs), name)
