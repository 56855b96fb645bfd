"""Fixed values of the script and URL rules, in natural order."""

# Dependent marks, and the order in which they follow a base (space and newline come last).
MARKS = "\u102b\u102c\u102d\u102e\u102f\u1030\u1031\u1032\u1036\u1037\u1038\u103a\u103b\u103c\u103d\u103e"
PRIORITY = {
    "\u103b": 1, "\u103c": 2, "\u103d": 3, "\u103e": 4, "\u1031": 5, "\u102d": 6, "\u102e": 7, "\u102f": 8, "\u1030": 9,
    "\u1032": 10, "\u102c": 11, "\u102b": 12, "\u1036": 13, "\u103a": 14, "\u1037": 15, "\u1038": 16, " ": 17, "\n": 18,
}
#: Bases that carry marks, and the wider sets of the damage scan.
INDEX = "\u1000-\u1021\u1025\u1027"
EXTRA_BASES = "\u1022\u1023\u1024\u1026\u1028\u1029\u102a\u103f"
PLACEHOLDERS = "-_\u2013\u2014"
LETTER_OR_MARK = "\u1000-\u1021\u1023-\u1029\u102b-\u1032\u1036-\u103e"
SPLIT = "\\s\u104a\u104b()\\[\\]\"\u2018\u2019\u201c\u201d,.:;?!/=+_\u2014-"
# Code points that are dropped.
GLUE = "#^{}\u00a0\u034f\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u2060\u221a\u25cc\ufeff"
# Sequences and what stands for them.
IMPOSTERS = {
    "\u101e\u103c\u1031\u103a": "\u102a", "\u1029\u103c\u1031\u103a": "\u102a", "\u1044\u1004\u103a\u1038": "\u104e\u1004\u103a\u1038",
    "\u1025\u102c\u100b\u103a": "\u1009\u102c\u100b\u103a", "\u1025\u102d\u102e\u1038": "\u1026\u1038", "\u1009\u102d\u102e\u1038": "\u1026\u1038",
    "\u1025\u1037\u103a": "\u1009\u1037\u103a", "\u1000\u1039\u1000": "\u1023", "\u102e\u102d\u1038": "\u102e\u1038", "\u102d\u102e\u1038": "\u102e\u1038",
    "\u101e\u1039\u101e": "\u103f", "\u1025\u102e\u1038": "\u1026\u1038", "\u1009\u102e\u1038": "\u1026\u1038", "\u1009\u102f\u1036": "\u1025\u102f\u1036",
    "\u1009\u1019\u103a": "\u1025\u1019\u103a", "\u1025\u103a": "\u1009\u103a", "\u101e\u103c": "\u1029",
    "\u107e": "\u103b", "\u107f": "\u103b", "\u1080": "\u103b", "\u1081": "\u103b", "\u1082": "\u103b", "\u1083": "\u103b", "\u1084": "\u103b",
    "\u1087": "\u103c", "\u1088": "\u103e\u102f", "\u1089": "\u103e\u1030", "\u108a": "\u103d\u103e", "\u1064": "\u1004\u103a\u1039",
    "\u108b": "\u1004\u103a\u1039\u102d", "\u108c": "\u1004\u103a\u1039\u102e", "\u108d": "\u1004\u103a\u1039\u1036", "\u108e": "\u102d\u1036",
    "\u1060": "\u1039\u1000", "\u1061": "\u1039\u1001", "\u1062": "\u1039\u1002", "\u1063": "\u1039\u1003", "\u1065": "\u1039\u1005", "\u1066": "\u1039\u1006",
    "\u1067": "\u1039\u1006", "\u1068": "\u1039\u1007", "\u1069": "\u1039\u1008", "\u106a": "\u1009", "\u106b": "\u100a", "\u106c": "\u1039\u100b",
    "\u106d": "\u1039\u100c", "\u106e": "\u100d\u1039\u100d", "\u106f": "\u100d\u1039\u100e", "\u1070": "\u1039\u100f", "\u1071": "\u1039\u1010",
    "\u1072": "\u1039\u1010", "\u1073": "\u1039\u1011", "\u1074": "\u1039\u1011", "\u1075": "\u1039\u1012", "\u1076": "\u1039\u1013", "\u1077": "\u1039\u1014",
    "\u1078": "\u1039\u1015", "\u1079": "\u1039\u1016", "\u107a": "\u1039\u1017", "\u107b": "\u1039\u1018", "\u107c": "\u1039\u1019", "\u1085": "\u1039\u101c",
    "\u1086": "\u103f", "\u108f": "\u1014", "\u1090": "\u101b", "\u1091": "\u100f\u1039\u100d", "\u1092": "\u100b\u1039\u100c", "\u1093": "\u1039\u1018",
    "\u1094": "\u1037", "\u1095": "\u1037", "\u1096": "\u1039\u1010\u103d", "\u1097": "\u100b\u1039\u100b", "\u105a": "\u102b\u103a", "\u1033": "\u102f",
    "\u1034": "\u1030", "\u107d": "\u103b",
}
# Pairs that cannot stand together; a kinzi without a base is counted apart.
IMPOSSIBLE = ("\u1036\u103a", "\u1032[\u102c\u102b]", "\u1032[\u102f\u1030]", "[\u102d\u102e][\u102c\u102b]", "[\u102c\u102b][\u102c\u102b]", "\u103a[\u103b\u103c\u103d\u103e]")
KINZI = "\u1004\u103a\u1039"

# Query keys of pages that are no downloads, tracking keys, search pages.
NON_DOWNLOAD_KEYS = ("share", "shared", "sharing", "share_source", "replytocom", "amp", "output", "print")
TRACKING_KEYS = ("fbclid", "gclid", "dclid", "msclkid", "yclid")
SEARCH_KEYS = ("s", "q", "query", "search", "search_query", "searchword", "keyword", "keywords")
# Families of hosts that are not crawled, first match first.
EXCLUDED = (
    ("wiki/reference sites are excluded", "wikipedia.org wikimedia.org wiktionary.org wikibooks.org wikinews.org wikiquote.org wikisource.org wikiversity.org wikivoyage.org wikidata.org mediawiki.org fandom.com wikia.com wiki.gg wikidot.com wikiwand.com miraheze.org"),
    ("YouTube/video-hosting pages are excluded", "youtube.com youtu.be youtube-nocookie.com"),
    ("Internet Archive pages are excluded", "archive.org"),
    ("app/software download sites are excluded", "apple.com appstore.com softonic.com apkpure.com apkpure.net uptodown.com apkmirror.com aptoide.com f-droid.org filehippo.com softpedia.com apps.microsoft.com"),
    ("Telegram messaging pages are excluded", "t.me telegram.me telegram.org telegram.dog"),
    ("GitHub-hosted code and pages are excluded", "github.com github.io githubusercontent.com github.dev github.blog github.community githubassets.com git.io"),
    ("search-engine results and redirectors are excluded", "google.com googleusercontent.com googleadservices.com g.co goo.gl bing.com bing.net duckduckgo.com duck.com brave.com mojeek.com searx.be searx.info searx.space searxng.com searxng.site yahoo.com yahoo.co.jp yahoo.net yandex.com yandex.ru yandex.net yandex.by yandex.kz yandex.ua yandex.uz yandex.az baidu.com baidu.cn baiducontent.com ecosia.org startpage.com ixquick.com qwant.com qwant.fr ask.com askjeeves.com aol.com naver.com daum.net sogou.com so.com sm.cn rambler.ru goo.ne.jp metager.org metager.de marginalia.nu yacy.net kiddle.co kidrex.org search.com seznam.cz search.ch lycos.com excite.com webcrawler.com metacrawler.com dogpile.com infospace.com hotbot.com searchencrypt.com swisscows.com gibiru.com kagi.com you.com yippy.com presearch.com yep.com wiby.me"),
)
SEARCH_LABELS = "google yandex yarndex yahoo baidu duckduckgo searx searxng"
# File hosts by provider.
PROVIDERS = (
    ("drive", "drive.google.com docs.google.com drive.usercontent.google.com drive.googleusercontent.com"),
    ("mega", "mega.nz mega.co.nz"),
    ("mediafire", "mediafire.com"),
    ("dropbox", "dropbox.com dropboxusercontent.com"),
    ("terabox", "terabox.com teraboxapp.com 1024terabox.com 1024tera.com"),
)
#: Latin letters to script letters, for deriving script text from other text.
LATIN = "abcdefghijklmnopqrstuvwxyz"
SCRIPT = "\u102c\u1017\u1005\u1012\u1031\u1016\u1002\u103e\u102d\u1007\u1000\u101c\u1019\u1014\u102f\u1015\u1040\u101b\u101e\u1010\u1030\u1039\u101d\u1001\u103a\u1036"
#: A second alphabet, whose text holds imposters and pairs that NFC reorders.
SCRIPT_2 = "\u1025\u103a\u1037\u101e\u103c\u1031\u1009\u102e\u1038\u1044\u1004\u102f\u1036\u1019\u102d\u1088\u1064\u108f\u1000\u1039\u1090\u107e\u106a\u102c\u100b\u1033"
#: The consonants that take each medial.
MEDIAL_HOSTS = {
    "\u103b": "\u1000\u1001\u1002\u1003\u1004\u1005\u1007\u100a\u100b\u100e\u100f\u1010\u1011\u1012\u1013\u1014\u1015\u1016\u1017\u1018\u1019\u101a\u101c\u101d\u101e\u101f",
    "\u103c": "\u1000\u1001\u1002\u1004\u1005\u100a\u1010\u1011\u1012\u1014\u1015\u1016\u1017\u1019\u101a",
    "\u103d": "\u1000\u1001\u1002\u1004\u1005\u1006\u1007\u100a\u100f\u1010\u1011\u1012\u1013\u1014\u1015\u1016\u1017\u1018\u1019\u101a\u101b\u101c\u101d\u101e\u101f",
    "\u103e": "\u1004\u1009\u100a\u100f\u1014\u1019\u101a\u101b\u101c\u101d\u1020",
}
#: Marks of download controls, of controls that are none, and the form fields that change with every visit.
DOWNLOAD_WORDS = r"(?i)\b(download(?:\s+now|\s+file)?|get\s+file|pdf|docx)\b"
OTHER_WORDS = r"(?i)\b(share|telegram|reply|comment|print|whatsapp|facebook|twitter|pinterest|bookmark|follow)\b"
VOLATILE_FIELDS = ("_token", "csrf_token", "csrfmiddlewaretoken", "authenticity_token", "__requestverificationtoken")
#: Frequent English words, words without vowels that exist, and pairs of letters that English never writes.
COMMON_ENGLISH = (
    "the of and a to in is you that it he was for on are as with his they i at be this have from or one had by word but not what all were we when "
    "your can said there use an each which she do how their if will up other about out many then them these so some her would make like him into "
    "time has look two more write go see number no way could people my than first water been call who its now find long down day did get come made "
    "may part update volume volumes three commission ministry education government language union myanmar grammar mlc jan feb mar apr jun jul aug "
    "sep oct nov dec am pm"
)
VOWELLESS = "shh hmm grr brr psst tsk cwm nth"
IMPOSSIBLE_LETTERS = "bq cq gq hq jq kq lq mq pq vq wq xq yq zq qg qh qj qk ql qm qo qr qs qv qw qx qy qz jz jx vx xz bz pz vz wz kx cx bx fx gx hx mx px dx qq yy"
