"""Quality counts against plain Python, and bands."""

from __future__ import annotations

import base64
import math
import random
import re
import unicodedata
from collections import Counter

import public_tokenizers
import tiktoken

from tidemark.llm import fertility
from tidemark.llm.common import table

DOCS = "doc_id bigint, text string, kept int"


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line) and line in seen:
            again += 1
        seen.add(line)
    counts = Counter(zip(words, words[1:], words[2:]))
    covered = {j for k in range(len(words) - 2) if counts[tuple(words[k : k + 3])] > 1 for j in range(k, k + 3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def brute_measures(name, text):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(name), "rb"))}
    encoding = tiktoken.Encoding("brute", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = encoding.encode_ordinary(text)

    def whole(i):
        try:
            encoding.decode_single_token_bytes(i).decode()
        except UnicodeDecodeError:
            return False
        return True

    n = len(ids)
    return len(text) / n, sum(not whole(i) for i in ids) / n, -sum(c / n * math.log2(c / n) for c in Counter(ids).values())


def check(spark, rows):
    got = fertility.judge(spark.createDataFrame(rows, DOCS)).collect()
    want = Counter((d, *brute_base(t)) for d, t, _ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    return got


def test_table_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text, 0) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    good = {r.doc_id for r in table(spark, sf, "labels").where("quality = 1").collect()}
    got = check(spark, rows)
    assert all(r.kept or r.base_failed for r in got if r.doc_id in good)
    assert any(not r.kept and not r.base_failed for r in got)


def test_odd_rows(spark):
    rows = [(1, None, 1), (1, None, 1), (None, "", 1), (2, " \n\t\n", 1), (3, "a b c a b c\na b c\na b c", 1), (4, "é ü 中 " * 60, 1), (5, "w" * 400_000, 1), (6, "x\r\nx\r\n\x0b\x0cy\x85z y", 1), (7, "Привет мир как дела " * 20, 1)]
    got = {(r.doc_id, r.script) for r in check(spark, rows)}
    assert (7, "Cyrillic") in got and (1, "Latin") in got
    assert fertility.judge(spark.createDataFrame([], DOCS)).collect() == []


def test_measures(spark):
    text = "The weather – it's fine, été ☂ 漢字 and 12345 more words. " * 3
    for name in fertility.VOCABULARIES:
        assert all(math.isclose(a, b) for a, b in zip(fertility.vocabulary(name).measures(text), brute_measures(name, text), strict=True))


def test_bands():
    band = fertility.Band(2, 8, 0.1, 5)
    assert fertility.in_band((4, 0, 6), band)
    assert not any(fertility.in_band(m, band) for m in ((1.9, 0, 6), (8.1, 0, 6), (4, 0.2, 6), (4, 0, 4.9)))
    noise = " ".join(base64.b64encode(bytes((k * 37 + j * 91) % 256 for j in range(12))).decode() for k in range(80))
    prose = "It was late in the year when the two travellers came down from the hills and saw, for the first time, the long grey town beside the river. Nobody met them there, though lamps were lit and a bell rang twice behind some wall they could not find; so they went on."
    latin = {n: fertility.BANDS[n]["Latin"] for n in fertility.VOCABULARIES}
    assert all(fertility.in_band(fertility.vocabulary(n).measures(prose), latin[n]) for n in latin)
    assert not all(fertility.in_band(fertility.vocabulary(n).measures(noise), latin[n]) for n in latin)


SCRIPTS = {
    "Han": (range(0x4e00, 0xa000), [
        "今天早上我们去了市场，买了一些新鲜的蔬菜和水果。天气很好，街上有许多人在散步。孩子们在公园里玩耍，老人坐在树下聊天。中午我们在一家小饭馆吃了面条，然后回家休息。晚上朋友来了，我们一起看电影，谈论工作和生活。他说明年要到北京学习历史，因为他对古代文化很感兴趣。",
        "今天早上我們去了市場,買了一些新鮮的蔬菜和水果。天氣很好,街上有許多人在散步。孩子們在公園裡玩耍,老人坐在樹下聊天。晚上朋友來了,我們一起看電影,談論工作和生活。",
        "學而時習之，不亦說乎？有朋自遠方來，不亦樂乎？人不知而不慍，不亦君子乎？其為人也孝弟，而好犯上者，鮮矣；不好犯上，而好作亂者，未之有也。君子務本，本立而道生。",
    ]),
    "Japanese": (range(0x3041, 0x30ff), [
        "昨日は友達と一緒に東京の美術館へ行きました。天気がとても良かったので、駅から歩いて行きました。美術館には多くの人がいて、静かに絵を見ていました。その後、近くの喫茶店でコーヒーを飲みながら、将来の仕事について話しました。夜は家に帰って、本を読んでから寝ました。",
        "コンピュータのプログラムをインストールして、インターネットでデータをダウンロードしました。サーバーのエラーが発生したので、サポートセンターに電話をかけました。",
    ]),
    "Hangul": (range(0xac00, 0xd7a4), [
        "오늘 아침 우리는 시장에 가서 신선한 채소와 과일을 샀습니다. 날씨가 아주 좋아서 많은 사람들이 거리를 걷고 있었습니다. 아이들은 공원에서 놀고 노인들은 나무 아래에 앉아 이야기를 나누었습니다. 저녁에는 친구들이 와서 함께 영화를 보고 일과 생활에 대해 이야기했습니다.",
        "대한민국의 주권은 국민에게 있고, 모든 권력은 국민으로부터 나온다. 국가는 법률이 정하는 바에 의하여 재외국민을 보호할 의무를 진다. 공무원은 국민전체에 대한 봉사자이다.",
    ]),
    "Arabic": (range(0x620, 0x64b), [
        "ذهبنا هذا الصباح إلى السوق واشترينا بعض الخضروات والفواكه الطازجة. كان الطقس جميلا وكان كثير من الناس يمشون في الشوارع. لعب الأطفال في الحديقة وجلس كبار السن تحت الأشجار يتحدثون عن الماضي. وفي المساء جاء أصدقاؤنا وشاهدنا فيلما معا وتحدثنا عن العمل والحياة.",
        "امروز صبح به بازار رفتیم و مقداری سبزی و میوه تازه خریدیم. هوا بسیار خوب بود و مردم زیادی در خیابان\u200cها قدم می\u200cزدند. بچه\u200cها در پارک بازی می\u200cکردند و پیرمردها زیر درختان نشسته بودند و درباره گذشته صحبت می\u200cکردند.",
        "آج صبح ہم بازار گئے اور کچھ تازہ سبزیاں اور پھل خریدے۔ موسم بہت اچھا تھا اور بہت سے لوگ سڑکوں پر چل رہے تھے۔ بچے پارک میں کھیل رہے تھے اور بزرگ درختوں کے نیچے بیٹھ کر باتیں کر رہے تھے۔",
    ]),
    "Hebrew": (range(0x5d0, 0x5eb), [
        "הבוקר הלכנו לשוק וקנינו ירקות ופירות טריים. מזג האוויר היה נעים ואנשים רבים טיילו ברחובות. הילדים שיחקו בפארק והזקנים ישבו מתחת לעצים ודיברו על העבר. בערב באו חברים, ראינו סרט יחד ושוחחנו על העבודה ועל החיים.",
        "ירושלים היא עיר הבירה של מדינת ישראל והעיר הגדולה בה. היא ממוקמת בהרי יהודה, ויש בה אתרים היסטוריים ודתיים רבים המושכים תיירים מכל העולם.",
    ]),
    "Devanagari": (range(0x904, 0x94e), [
        "आज सुबह हम बाज़ार गए और कुछ ताज़ी सब्जियाँ और फल खरीदे। मौसम बहुत अच्छा था और सड़कों पर बहुत से लोग घूम रहे थे। बच्चे पार्क में खेल रहे थे और बुजुर्ग पेड़ों के नीचे बैठकर बातें कर रहे थे। शाम को दोस्त आए, हमने साथ में फिल्म देखी और काम के बारे में बात की।",
        "आज सकाळी आम्ही बाजारात गेलो आणि काही ताज्या भाज्या व फळे विकत घेतली. हवामान खूप छान होते आणि रस्त्यावर बरेच लोक फिरत होते. मुले बागेत खेळत होती आणि वृद्ध झाडाखाली बसून गप्पा मारत होते.",
    ]),
    "Thai": (range(0xe01, 0xe4f), [
        "เช้านี้เราไปตลาดและซื้อผักและผลไม้สด อากาศดีมาก มีคนเดินเล่นอยู่บนถนนมากมาย เด็กๆ เล่นอยู่ในสวนสาธารณะ ผู้สูงอายุนั่งคุยกันใต้ต้นไม้ ตอนเย็นเพื่อนมาที่บ้าน เราดูหนังด้วยกันและคุยเรื่องงานและชีวิต",
        "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย มีประชากรหลายล้านคน และเป็นศูนย์กลางทางเศรษฐกิจ การศึกษา และวัฒนธรรมของประเทศ",
    ]),
    "Tamil": (range(0xb85, 0xbce), [
        "இன்று காலை நாங்கள் சந்தைக்குச் சென்று சில புதிய காய்கறிகளையும் பழங்களையும் வாங்கினோம். வானிலை மிகவும் நன்றாக இருந்தது. குழந்தைகள் பூங்காவில் விளையாடிக் கொண்டிருந்தனர்.",
        "தமிழ் மொழி உலகின் மிகப் பழமையான மொழிகளில் ஒன்றாகும். இது இந்தியா, இலங்கை, சிங்கப்பூர் ஆகிய நாடுகளில் பேசப்படுகிறது.",
    ]),
    "Armenian": (range(0x561, 0x587), [
        "Այսօր առավոտյան մենք գնացինք շուկա և գնեցինք թարմ բանջարեղեն և մրգեր։ Եղանակը շատ լավ էր, և շատ մարդիկ քայլում էին փողոցներում։ Երեխաները խաղում էին այգում։",
        "Երևանը Հայաստանի մայրաքաղաքն է և ամենամեծ քաղաքը։ Այն գտնվում է Հրազդան գետի ափին և հայտնի է իր հնագույն պատմությամբ և մշակույթով։",
    ]),
}
#: What no vocabulary knows.
UNKNOWN = {
    "Bengali": "আজ সকালে আমরা বাজারে গিয়ে কিছু তাজা সবজি ও ফল কিনেছি। আবহাওয়া খুব ভালো ছিল এবং অনেক মানুষ রাস্তায় হাঁটছিল। শিশুরা পার্কে খেলছিল আর বৃদ্ধরা গাছের নিচে বসে গল্প করছিল।",
    "Georgian": "დღეს დილით ჩვენ წავედით ბაზარში და ვიყიდეთ ახალი ბოსტნეული და ხილი. ამინდი ძალიან კარგი იყო და ბევრი ხალხი სეირნობდა ქუჩებში. ბავშვები თამაშობდნენ პარკში.",
}


def noise(letters, seed, words=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(words))


def fits(text):
    kind = fertility.script(text)
    return all(fertility.in_band(fertility.vocabulary(n).measures(text), b.get(kind, b["Other"])) for n, b in fertility.BANDS.items())


def test_noise_of_each_script_is_told_from_prose():
    for name, (codes, prose) in SCRIPTS.items():
        letters = [chr(c) for c in codes if unicodedata.category(chr(c))[0] in "LM"]
        for text in prose:
            assert fertility.script(text) == name and fits(text), text
        for seed in range(10):
            text = noise(letters, seed)
            assert fertility.script(text) == name and not fits(text), (name, seed)
            mixed = noise([*letters, *map(chr, range(0x1F300, 0x1F640))], seed)
            assert not fits(mixed), (name, seed)


def test_noise_is_not_kept(spark):
    letters = {name: [chr(c) for c in codes if unicodedata.category(chr(c))[0] in "LM"] for name, (codes, _) in SCRIPTS.items()}
    rows = [(k, noise(own, k), 0) for k, own in enumerate(letters.values())]
    assert not any(r.base_failed or r.kept for r in check(spark, rows))


def test_scripts_that_no_vocabulary_knows_are_not_judged():
    for text in UNKNOWN.values():
        assert fertility.script(text) == "Other" and fits(text)
    assert not fits("და " * 100)


def test_long_texts_are_encoded_whole():
    """Beside encoding at once, above the length at which a text is taken in parts."""
    draw = random.Random(4)
    blanks = " \n\t\r 　\x1c"
    texts = [
        "information" * 30_000,
        "".join(draw.choice("abcdefghij") for _ in range(400_000)),
        "word " * 120_000,
        "".join(draw.choice("ab, .\n'st  12中é😀 ") for _ in range(600_000)),
        "a" + " " * 5_000 + "b" + "\n" * 4_096 + " 7" + "\t" * 4_095 + "x" + " " * 9_000,
        " " * 6_000,
        "x" + "".join(draw.choice(blanks) for _ in range(50_000)) + "end",
        ("some words " * 2_000 + " " * 4_500) * 15,
    ]
    for name in fertility.VOCABULARIES:
        v = fertility.vocabulary(name)
        for text in texts:
            assert v.encode(text).tolist() == v.encoding.encode_ordinary(text)
        # A run of blanks on which the pattern itself gives up.
        ids = v.encode(long := "a" + " " * 2_000_000 + "b")
        assert v.encoding.decode(ids.tolist()) == long


def test_kept_is_the_bands_verdict(spark):
    """Verdicts recomputed from tokens that the library gives, for each script's bands."""
    rows = [(r.doc_id, r.text, 0) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    rows += [(-1 - k, (word + " ") * 3 + " ".join(random.Random(k).sample([*"abcdefghijklmnopqrstuvwxyz"] * 4, 100)) + "information" * 30_000 * (k == 1), 0) for k, word in enumerate(("plain", "long", "слово"))]
    got = {r.doc_id: r for r in fertility.judge(spark.createDataFrame(rows, DOCS)).collect()}
    for doc, text, _ in rows:
        failed = brute_base(text)[-1]
        inside = True
        for name in fertility.VOCABULARIES:
            chars, lone, entropy = brute_measures(name, text) if text else (0, 0, 0)
            band = fertility.BANDS[name].get(got[doc].script, fertility.BANDS[name]["Other"])
            inside &= band.least_chars <= chars <= band.most_chars and lone <= band.most_bytes and entropy >= band.least_entropy
        assert got[doc].kept == (inside and not failed), doc
