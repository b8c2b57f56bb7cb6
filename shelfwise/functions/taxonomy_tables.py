"""The standard categories and how names are mapped to them. Fixed values throughout.

The order of ``RULES`` is part of their meaning: the first rule that fits decides, so a notebook
computer whose name has the word for notebook is filed under books.
"""

from __future__ import annotations

CATEGORIES = (
    "식품",
    "생활/주방",
    "뷰티/헬스",
    "패션/잡화",
    "디지털/가전",
    "가구/홈",
    "스포츠/레저",
    "유아/반려",
    "도서/취미/문구",
    "여행/e쿠폰",
)

#: Category slugs with their standard category.
ALIASES = {
    "식품": """
        신선식품 가공식품 식품-신선 식품-가공 간식 간식빵 선식-시리얼 식용유-참기름-오일 브로콜리-파프리카-양배추 소시지-베이컨-하몽 달걀-가공란 달걀 명란 디저트 오징어-낙지-문어 국
        치즈 코코아-밀크티-기타-차 수입산-돼지고기-양고기 신선하게-받아보는 닭고기 닭가슴살 닭-오리고기 밀가루-가루-믹스 김-미역-해조류 치킨-피자-핫도그-만두 잡곡 멸치-황태-다시팩
        떡볶이 떡-한과 초콜릿-젤리-캔디 증류주-약주-청주 콩나물-버섯 두부-어묵-부침개 아이스크림 이유식-재료 분유-간편-이유식 짜장-짬뽕-파스타-면류 피자 친환경 6월신상품 7월신상품
        조미료 소금-설탕-향신료 회-탕류 탕 양념-액젓-장류 죽-스프-카레 구수한-집밥 풍성하게-담은 논알콜-무알콜 햄-통조림-병조림 식초-소스-드레싱 간단히-맛보는 찌개 식단관리용-
        가공육 집밥의발견
    """.split(),
    "생활/주방": """
        생활 주방 생필품 생필품-육아 수건 스크럽-대디
    """.split(),
    "뷰티/헬스": """
        뷰티 화장품 립메이크업 건강 헬스 여성-위생용품 구강-면도 프로틴
    """.split(),
    "패션/잡화": """
        패션 패션-의류 잡화 가방 신발 운동화
    """.split(),
    "디지털/가전": """
        디지털 가전 컴퓨터 보조배터리 키보드 선풍기
    """.split(),
    "가구/홈": """
        가구 홈 홈패브릭 책상 테이블-식탁-책상
    """.split(),
    "스포츠/레저": """
        스포츠 스포츠-건강 수영
    """.split(),
    "유아/반려": """
        유아 육아 반려 펫 강아지-주식 장난감
    """.split(),
    "도서/취미/문구": """
        도서 도서-음반 취미-문구-펫 문구 취미
    """.split(),
    "여행/e쿠폰": """
        여행 e쿠폰 이쿠폰 쿠폰
    """.split(),
}

#: Words in a category name, in order: the first that fits decides.
NAME_WORDS = (
    ("식품", """
        식품 간식 고기 닭 돼지 소고 수산 해조 면류 떡 빵 치즈 우유 분유 이유식 아이스크림 초콜릿 피자 만두 시리얼 친환경 조미료 소스 장류 찌개 탕류 통조림
    """.split()),
    ("생활/주방", """
        생활 주방 수건 세제 휴지 스크럽
    """.split()),
    ("뷰티/헬스", """
        뷰티 헬스 화장 위생 구강 면도 프로틴
    """.split()),
    ("패션/잡화", """
        패션 잡화 의류 신발 운동화 가방
    """.split()),
    ("디지털/가전", """
        디지털 가전 컴퓨터 선풍기 키보드
    """.split()),
    ("가구/홈", """
        가구 홈 침구 테이블 책상
    """.split()),
    ("스포츠/레저", """
        스포츠 레저 수영
    """.split()),
    ("유아/반려", """
        유아 육아 반려 펫 강아지 고양이
    """.split()),
    ("도서/취미/문구", """
        도서 취미 문구 음반
    """.split()),
    ("여행/e쿠폰", """
        여행 쿠폰 e쿠폰
    """.split()),
)

#: (category, words in category, path or search keyword, words in the product name), in order.
RULES = (
    (
        "도서/취미/문구",
        (),
        """
            도서 책 문구 노트 펜 연필 필기구 음반 앨범 취미 피규어 퍼즐
        """.split(),
    ),
    (
        "유아/반려",
        """
            유아 육아 출산 아기 베이비 키즈 기저귀 장난감 강아지 고양이 반려 펫 사료 주식
        """.split(),
        """
            유아 육아 출산 아기 베이비 키즈 기저귀 장난감 강아지 고양이 반려 펫 사료 간식 주식
        """.split(),
    ),
    (
        "여행/e쿠폰",
        """
            e쿠폰 이쿠폰 쿠폰 기프티콘 상품권 교환권 모바일쿠폰 여행 항공 숙박 호텔 렌터카 티켓
        """.split(),
        (),
    ),
    (
        "도서/취미/문구",
        """
            도서 음반 문구 취미
        """.split(),
        """
            도서 책 문구 노트 펜 연필 음반 앨범 취미 피규어 퍼즐
        """.split(),
    ),
    (
        "패션/잡화",
        """
            패션 잡화 의류 신발 가방 쥬얼리 주얼리 시계 모자
        """.split(),
        """
            의류 티셔츠 셔츠 팬츠 원피스 신발 운동화 가방 백팩 모자 양말
        """.split(),
    ),
    (
        "디지털/가전",
        """
            디지털 가전 컴퓨터 모바일 노트북 전자 보조배터리 키보드 마우스 모니터 충전기 케이블 이어폰 헤드셋
        """.split(),
        """
            노트북 키보드 마우스 모니터 충전기 케이블 이어폰 헤드셋 보조배터리 가전
        """.split(),
    ),
    (
        "가구/홈",
        """
            가구 홈 침구 인테리어 수납 조명 책상 테이블 식탁 홈패브릭
        """.split(),
        """
            침대 소파 책상 의자 수납장 선반 매트리스 커튼 러그 이불 베개 테이블 식탁 홈패브릭
        """.split(),
    ),
    (
        "스포츠/레저",
        """
            스포츠 레저 캠핑 골프 등산 낚시 자동차 공구 수영
        """.split(),
        """
            운동 스포츠 골프 캠핑 등산 자전거 헬멧 보호대 낚시 수영
        """.split(),
    ),
    (
        "뷰티/헬스",
        """
            뷰티 화장 헬스 건강 미용 립메이크업 메이크업
        """.split(),
        """
            화장품 선크림 마스크팩 샴푸 바디워시 스킨 로션 크림 콜라겐 비타민 영양제 립스틱 립메이크업 메이크업
        """.split(),
    ),
    (
        "식품",
        (),
        """
            채소 과일 정육 닭고기 돼지고기 소고기 수산 생선 새우 계란 달걀 샐러드 쌀 잡곡 간편식 밀키트 반찬 김치 라면 떡볶이 만두 피자 냉동 과자 초콜릿 커피 차 주스 생수 베이커리
            우유 요거트 치즈 버터 식품 푸드 고기 음료 양배추 브로콜리 파프리카 오이 당근 양파 감자 고구마 토마토 사과 배 바나나 포도 귤 딸기 한우 소시지 베이컨 하몽 명란 오징어 낙지
            문어 디저트 코코아 밀크티 국
        """.split(),
    ),
    (
        "식품",
        (
            "신선식품", "가공식품", "식품", "푸드", "채소", "과일", "정육", "수산", "계란", "달걀", "쌀", "간편식", "밀키트", "반찬", "김치", "라면",
            "냉동", "과자", "커피", "음료", "생수", "베이커리", "우유", "양배추", "브로콜리", "파프리카", "오이", "당근", "양파", "감자", "고구마",
            "토마토", "사과", "바나나", "소시지", "베이컨", "하몽", "명란", "오징어", "낙지", "문어", "디저트", "코코아", "밀크티", "기타 차", "치즈",
            "국", "신선하게 받아보는", "돼지고기", "양고기",
        ),
        (),
    ),
    (
        "생활/주방",
        """
            생활 주방 생필품 세제 휴지 청소 욕실 세탁 수건
        """.split(),
        """
            세제 휴지 티슈 칫솔 치약 수건 주방 프라이팬 냄비 그릇 청소 욕실 세탁
        """.split(),
    ),
)
