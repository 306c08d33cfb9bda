"""Vocabularies of the rules, as bar-separated strings in code point order."""

from __future__ import annotations

#: First-person words; those of TWICE belong to two languages and count for each.
FIRST_PERSON = (
    'ben|benim|biz|bizim|eu|i|ich|ik|io|ja|jag|je|kami|kita|ma|me|mein|meine|mes|meu|mi|mia|mijn|min|mine|minha|mio|mis|mitt|moja|mon|my|myself|mój|nasz|noi|nosotros|nosso|nostro|notre|nous|nuestro|nós|onze|our|ourselves|saya|tôi|unser|vi|vår|we|wij|wir|yo'
)
TWICE = 'my'
FIRST_PERSON_PHRASES = (
    'chúng tôi|của tôi'
)
#: First-person markers of scripts whose words are not parted by blanks, or are matched inside a word.
MARKERS = (
    ' мое| мои| мой| моя| моє| мої| мій| наш|я |أنا|لي|نحن|मेरा|मेरी|मैं|हम|हमारा|ฉัน|ดิฉัน|ผม|เรา|ぼく|わたし|俺|僕|我|我们|我的|私|나는|내|우리|저는|저의'
)
NARRATIVE = (
    'back home|eu cresci|eu lembro|i always|i came|i discovered|i feel|i grew up|i left|i miss|i moved|i never forgot|i realized|i recall|i remember|i used'
    ' to|i was born|meu pai|minha família|minha mãe|my childhood|my family|my father|my grandfather|my grandmother|my grandparents|my hometown|my mother|my'
    ' parents|quando eu era|when i was|小时候|我从小|我出生|我怀念|我思念|我的家|我记得|我长大'
)
HARD = (
    'add to cart|agoda|airport transfer|all rights reserved|ancestry.com|apply now|arrival instructions|bestseller|booking.com|buy it now|buy now|census '
    'records|check-in|check-out|click here|contact us|copyright ©|court, land & probate|create account|curriculum vitae|dictionary|directories & member '
    "lists|discography|don't miss out|employment history|encyclopedia|family tree builder|family trees & communities|feat.|finding aids|forget "
    'password|free trial|gedcom|genealogy|gps|hostelworld|how to get there|immigration records|instrumental|karaoke|latitude|limited time|log '
    'in|login|longitude|lyrics by|military records|money back guarantee|myheritage|off your order|official audio|official video|password|price:|privacy '
    'policy|produced by|professional portfolio|remix|reserve|save %|search billions|sheet music|shopping cart|shuttle|sign in|sign up|site '
    'index|songwriter|special offer|subscribe today|terms of service|terms of use|tripadvisor|vital records|wikipedia'
)
SOFT = (
    'bus|confirmation|directions|map|portfolio|reception|resume|station|stop|train'
)
NAVIGATION = (
    '10月|11月|12月|1月|2月|3月|4月|5月|6月|7月|8月|9月|april|august|chinese|czech|danish|december|dutch|english|february|finnish|french|german|italian|january|japanese|july|june|korean|march|may|norwegian|november|october|polish|portuguese|russian|september|spanish|swedish|turkish|vietnamese|中文|丹麦|俄语|德语|意大利语|挪威语|捷克|日语|法语|波兰语|瑞典语|芬兰语|英语|荷兰语|葡萄牙语|西班牙语|韩语'
)

KEYWORDS = {
    'ar': (
    'أرض الوطن|أسلاف|أصول|اغتراب|الحنين إلى الوطن|الشعور بالانتماء|العودة إلى الوطن|الوطن الأم|انتماء|بلد الأصل|تراث|جذور|حنين|ذكريات '
    'الطفولة|شتات|طفولة|غربة|مسقط الرأس|مسقط رأس|منفى|نشأت|وطن'
),
    'de': (
    'Abstammung|Ahnen|Diaspora|Entwurzelung|Exil|Geburtsort|Geburtsstadt|Heimat|Heimatdorf|Heimatort|Heimatstadt|Heimkehr|Heimweh|Herkunft|Kindheit|Kindheitserinnerungen|Mutterland|Nostalgie|Sehnsucht|Vaterland|Verwurzelung|Wurzeln|Zugehörigkeit|Zugehörigkeitsgefühl|Zuhause|nach'
    ' Hause|wo ich aufgewachsen bin|wo ich herkomme'
),
    'en': (
    'ancestral|ancestral home|ancestry|back to my roots|birthplace|childhood home|childhood memories|cultural '
    'roots|diaspora|displacement|exile|fatherland|going back home|growing up|heritage|home country|home town|home '
    'village|homecoming|homeland|homesick|homesickness|hometown|motherland|my roots|native land|native town|nostalgia|place of origin|return '
    'home|rootedness|sense of belonging|upbringing|uprooted|where I belong|where I come from|where I grew up'
),
    'es': (
    'ancestros|arraigo|añoranza|ciudad natal|desarraigo|diáspora|donde crecí|exilio|herencia|infancia|lugar de origen|madre patria|mi '
    'hogar|morriña|niñez|nostalgia|orígenes|patria|pertenencia|pueblo natal|raíces|recuerdos de infancia|sentido de pertenencia|tierra natal|volver a casa'
),
    'fr': (
    "ancêtres|appartenance|chez moi|diaspora|déracinement|enfance|enracinement|exil|héritage|lieu de naissance|là où j'ai grandi|mal du pays|mon foyer|mère"
    " patrie|nostalgie|origines|patrie|pays natal|racines|retour au pays|sentiment d'appartenance|souvenirs d'enfance|terre natale|ville natale"
),
    'hi': (
    'अपनापन|गांव|घर|घर की याद|जड़ें|जन्मभूमि|जहाँ मैं बड़ा हुआ|जुड़ाव|देश|पुरानी यादें|पूर्वज|पैतृक गाँव|प्रवासी|बचपन|बचपन की '
    'यादें|मातृभूमि|मूल|विरासत|विस्थापन'
),
    'id': (
    'akar|asal usul|diaspora|ibu pertiwi|kampung halaman|kenangan masa kecil|leluhur|masa kecil|nostalgia|pengasingan|pulang kampung|rasa kepunyaan|rasa '
    'memiliki|rindu kampung|rindu rumah|rumah saya|tanah air|tanah kelahiran|tempat asal|tempat saya dibesarkan|warisan'
),
    'it': (
    'antenati|appartenenza|casa mia|città natale|diaspora|dove sono cresciuto|eredità|esilio|infanzia|luogo di nascita|madrepatria|mal di '
    "casa|nostalgia|origini|paese natale|patria|radicamento|radici|ricordi d'infanzia|senso di appartenenza|sradicamento|terra d'origine|tornare a casa"
),
    'ja': (
    'ふるさと|ホームシック|ルーツ|先祖|出身地|地元|子供時代|帰属|帰属意識|帰郷|幼い頃|幼少期|懐かしい|所属感|故郷|望郷|根|母国|生まれ故郷|祖国|育った場所|起源|郷愁|里帰り'
),
    'ko': (
    '고향|고향으로|귀속감|귀향|그리움|기원|디아스포라|모국|뿌리|소속감|어린 시절|어릴 때|유년기|유산|자란 곳|조국|조상|출생지|태어난 곳|향수|향수병'
),
    'nl': (
    'afkomst|ballingschap|diaspora|erfgoed|geboortedorp|geboorteplaats|geboortestad|gevoel van '
    'thuishoren|heimwee|jeugd|jeugdherinneringen|kindertijd|moederland|naar huis|nostalgie|saamhorigheid|thuiskomen|vaderland|verbondenheid|voorouders|waar'
    ' ik ben opgegroeid|wortels'
),
    'pl': (
    'diaspora|dzieciństwo|dziedzictwo|emigracja|gdzie dorastałem|korzenie|mała ojczyzna|miejsce urodzenia|nostalgia|ojczyzna|pochodzenie|poczucie '
    'przynależności|powrót do domu|przodkowie|przynależność|rodzinne miasto|tęsknota za domem|wspomnienia z dzieciństwa|wygnanie|zakorzenienie'
),
    'pt': (
    'ancestrais|cidade natal|desenraizamento|diáspora|enraizamento|exílio|herança|infância|lugar de origem|memórias de infância|meu lar|mãe '
    'pátria|nostalgia|onde cresci|origens|pertencimento|pátria|raízes|saudade|saudades de casa|senso de pertencimento|terra natal|voltar para casa'
),
    'ru': (
    'возвращение домой|воспоминания детства|где я вырос|детство|диаспора|домой|изгнание|истоки|корни|малая родина|место '
    'рождения|наследие|ностальгия|отечество|отчизна|предки|принадлежность|происхождение|родина|родной город|тоска по дому|тоска по родине|чувство '
    'принадлежности|эмиграция'
),
    'sv': (
    'arv|barndom|barndomsminnen|diaspora|där jag växte upp|exil|fosterland|födelseort|förfäder|hem|hemby|hemkomst|hemlängtan|hemstad|känsla av '
    'tillhörighet|moderland|nostalgi|rötter|tillhörighet|ursprung'
),
    'th': (
    'กลับบ้าน|การเป็นส่วนหนึ่ง|ความคิดถึง|ความทรงจำวัยเด็ก|ความเป็นส่วนหนึ่ง|คิดถึงบ้าน|ต้นกำเนิด|ที่ที่ฉันเติบโต|บรรพบุรุษ|บ้านเกิด|พลัดถิ่น|ภูมิลำเนา|มรดก|มาตุภูมิ|รากเหง้า|ลี้ภัย|วัยเด็ก|แผ่นดินแม่'
),
    'tr': (
    'aidiyet|aidiyet duygusu|ait olmak|ana yurt|anavatan|atalar|büyüdüğüm yer|diaspora|doğduğum yer|eve '
    'dönüş|gurbet|göç|hasret|köken|kökler|memleket|memleketim|miras|nostalji|sürgün|vatan|yurt|çocukluk|çocukluk anıları|özlem'
),
    'uk': (
    'батьківщина|вигнання|витоки|відчуття належності|вітчизна|де я виріс|дитинство|діаспора|еміграція|коріння|мала батьківщина|місце '
    'народження|належність|ностальгія|повернення додому|походження|предки|рідне місто|спадщина|спогади дитинства|туга за домом'
),
    'vi': (
    'cảm giác thuộc về|cội nguồn|di sản|hoài niệm|kiều bào|kỷ niệm tuổi thơ|lưu vong|nguồn gốc|nhớ nhà|nơi sinh|nơi tôi lớn lên|nỗi nhớ quê|quê hương|quê '
    'nhà|sự thuộc về|trở về quê|tuổi thơ|tổ quốc|tổ tiên|về nhà|đất mẹ'
),
    'zh': (
    '乡愁|儿时|出生地|原籍|家乡|家园|家鄉|寻根|小时候|归属感|思乡|故乡|故土|故鄉|根|根源|歸屬感|母国|祖国|童年|童年回憶|老家|落叶归根|衣锦还乡|鄉愁|长大的地方'
),
}
UNIVERSAL = (
    'diaspora|homeland|hometown|motherland|nostalgia'
)


def items(bars: str) -> tuple[str, ...]:
    return tuple(bars.split("|"))


def keywords(language: str | None = None) -> tuple[str, ...]:
    """Lower-cased keywords of a language and of all languages, or of every one; sorted and distinct."""
    chosen = KEYWORDS.values() if language is None else [KEYWORDS[language]] if language in KEYWORDS else []
    return tuple(sorted({w.lower() for bars in (*chosen, UNIVERSAL) for w in items(bars)}))
