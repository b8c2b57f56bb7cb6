"""Word lists of the keyword rules. Fixed values throughout: results depend on every entry."""

from __future__ import annotations

#: English words with their standard Korean keyword.
CANONICAL_ENGLISH = dict(
    pair.split(":")
    for pair in """
    bag:가방 bags:가방 babies:유아 baby:유아 ankle:발목 backpack:백팩 band:밴드 beanie:비니 bath:욕실 bathroom:욕실 beauty:뷰티
    bedding:침구 box:박스 bracelet:팔찌 cap:모자 carri:캐리어 butter:버터 cabinet:수납장 cabinets:수납장 calculator:계산기 cat:고양이
    cats:고양이 cheese:치즈 chicken:닭고기 children:유아 collagen:콜라겐 coffee:커피 cosmetic:화장품 cosmetics:화장품 desk:책상
    detergent:세제 diap:기저귀 digital:디지털 dog:강아지 dogs:강아지 dress:의류 dried:건조 electronic:전자 eyebrow:눈썹 eyelash:속눈썹
    fashion:패션 fish:생선 food:식품 frying:프라이팬 gifticon:기프티콘 fresh:신선 fruit:과일 fruits:과일 germanium:게르마늄 grocery:식품
    guard:보호대 health:건강 hobby:취미 insol:깔창 insole:깔창 keyboard:키보드 kitchen:주방 laptop:노트북 laver:김 luggage:여행가방
    lunch:도시락 mask:마스크 men:남성 milk:우유 neck:목 necktie:넥타이 noodle:라면 noodles:라면 oil:오일 pan:프라이팬 pet:펫 pets:펫
    puppies:강아지 puppy:강아지 rack:선반 rice:쌀 razor:면도기 shampoo:샴푸 shelf:선반 shoe:신발 shoes:신발 snack:간식 snacks:간식
    sport:스포츠 stationery:문구 storage:수납 sunscreen:선크림 silicon:실리콘 tissue:티슈 toe:발가락 towel:수건 travel:여행
    vegetable:채소 vegetables:채소 warm:워머 water:생수 women:여성 yogurt:요거트
    """.split()
)

#: Korean words with their standard keyword.
CANONICAL_KOREAN = dict(pair.split(":") for pair in "강아지사료:강아지 고양이사료:고양이 반려견:강아지 반려묘:고양이 욕실장:수납장 키친:주방".split())

#: Words that make no two-word keyword.
GENERIC = frozenset(
    """
    best new sale hot made korea korean 무료 배송 상품 정품 공식 국내 국산
    """.split()
)

#: English words that are no keyword.
STOPWORDS_ENGLISH = frozenset(
    """
    a about above after again all also am an and any are as at be because been before being best between both
    but by automatic basic black can capacity casio certification certificat cks cm comfort could day diamond
    each eas edition exclusive for from functional futuro gmarket goods had has have he her here high him his
    hot how giveaway haccp in into invitate invitation invitational invite is it item its kookmin korea korean
    kurly limit limited made market marketkurly military mm more most multi manual medicine natural new no not
    of office official olbaan on one only or other our out over pack per plus portable premium product products
    purpose sale seban set she slim sneak so some starbuck sticky such supplies than that the their them then
    there these they this to up use using wando was we were what when where which who will with you your
    """.split()
)

#: Korean words that are no keyword.
STOPWORDS_KOREAN = frozenset(
    """
    가격 기획 골라 골라담기 담기 단독 대용량 마켓컬리 묶음 무료 무료배송 배송 베스트 상품 선택 세일 세트 신상 옵션 전용 정품 추가 컬리 특가 할인 공식 국내 국산 모음 수입 신선 예약 인기
    증정 직구 카시오 해외
    """.split()
)

#: Ends of Korean words that are cut one after the other, and particles of which the first that fits is cut.
KOREAN_ENDINGS = ("전용", "용", "형", "식")
KOREAN_PARTICLES = tuple("으로 에서 부터 까지 에게 하고 처럼 보다 과 와 을 를 이 가 은 는 로 에 의 도 만".split())
#: English endings: (ending, longer than, put in its place); the first that fits is used.
ENGLISH_ENDINGS = (
    ("ational", 8, "ate"),
    ("ies", 5, "y"),
    ("ing", 6, ""),
    ("ers", 6, ""),
    ("er", 5, ""),
    ("ed", 5, ""),
    ("ly", 5, ""),
    ("es", 5, ""),
    ("s", 4, ""),
)
