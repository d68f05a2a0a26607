"""Labelled URLs for the URL filter, made from a rule.

What tells bad URLs from good ones here is their form: throw-away and stuffed hosts, tokens,
long queries, deep doorways. Hosts of both kinds are made of the same words, so no word
decides, and each kind has members that look like the other. Suffixes differ in how many of
their URLs are bad, as real ones do.
"""

from __future__ import annotations

import random

# Of 100 URLs under a suffix, so many are bad.
BAD_OF_100 = {
    "com": 40, "net": 45, "org": 25, "edu": 8, "uk": 25, "de": 25, "fr": 25, "io": 35,
    "museum": 8, "info": 65, "biz": 70, "top": 80, "xyz": 75, "shop": 60, "click": 85,
}
PER_SUFFIX = 120
SEED = 11

_WORDS = (
    "garden harbour kettle meadow printing museum choir orchard lantern ferry granite violin "
    "planet copper bridge weather market ticket travel health credit phone reward music video "
    "winter school kitchen letter island engine forest window camera paper"
).split()


class _Maker:
    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)

    def word(self) -> str:
        return self.rng.choice(_WORDS)

    def slug(self, low: int, high: int, sign: str = "-") -> str:
        return sign.join(self.word() for _ in range(self.rng.randint(low, high)))

    def number(self, low: int = 1, high: int = 9999) -> str:
        return str(self.rng.randint(low, high))

    def token(self, low: int, high: int, signs: str = "0123456789abcdef") -> str:
        return "".join(self.rng.choices(signs, k=self.rng.randint(low, high)))

    def query(self, low: int, high: int, values: int) -> str:
        count = self.rng.randint(low, high)
        return "?" + "&".join(f"{self.token(1, 4, 'acdikpqrstu')}={self.token(1, values)}" for _ in range(count))

    def host(self) -> str:
        owner = self.rng.choice((self.word() + self.word(), self.slug(1, 2), self.word()))
        between = self.rng.choice(("", "", "", f".{self.word()}", ".co"))
        return self.rng.choice(("", "www.", "www.", "m.", "docs.", "ads.", "blog.")) + owner + between

    def page(self) -> str:
        """The path and query of an ordinary page."""
        return self.rng.choice(
            (
                lambda: "",
                lambda: "/",
                lambda: f"/{self.slug(1, 1)}/{self.slug(2, 5)}",
                lambda: f"/{self.number(1998, 2025)}/{self.number(1, 12)}/{self.slug(2, 6)}/",
                lambda: f"/story/{self.number()}",
                lambda: f"/{self.word()}/{self.number()}.html#part",
                lambda: f"/node/{self.number()}?p={self.number(1, 9)}",
                lambda: f"/x/{self.number()}?from={self.word()}&p={self.number(1, 9)}",
                lambda: f"/wiki/{self.slug(1, 4, '_')}",
                lambda: f"/{self.word()}/{self.word()}/{self.word()}/{self.slug(1, 3)}.html",
                lambda: f"/search?q={self.slug(1, 3, '+')}&lang=en&sort=date",
            )
        )()

    def good(self, suffix: str) -> str:
        # Some good URLs carry a token or a long query too.
        tail = self.page()
        if self.rng.random() < 0.06:
            tail = f"/doc/{self.token(12, 32)}" + (self.query(2, 4, 6) if self.rng.random() < 0.4 else "")
        return f"{self.host()}.{suffix}{tail}"

    def bad(self, suffix: str) -> str:
        spent = "0123456789bcdfghjklmnpqrstvwxz"
        return self.rng.choice(
            (
                # A redirect with tokens and many parameters.
                lambda: f"{self.host()}.{suffix}/c/{self.token(16, 40)}{self.query(3, 7, 10)}",
                # A host used once.
                lambda: f"{self.token(6, 14, spent)}.{suffix}{self.page()}",
                lambda: f"{self.token(4, 9, spent)}.{self.token(5, 9, spent)}.{suffix}/{self.token(6, 16)}",
                # A host stuffed with words.
                lambda: f"{self.slug(4, 6)}-{self.number(1, 999)}.{suffix}{self.page()}",
                # A foreign name in front of the real host.
                lambda: f"{self.word()}.{self.word()}.{self.slug(2, 3)}.{self.word()}{self.number()}.{suffix}"
                f"/{self.word()}/{self.token(8, 24)}/login.php{self.query(1, 4, 20)}",
                # A deep doorway.
                lambda: f"{self.host()}.{suffix}/" + "/".join(self.word() for _ in range(self.rng.randint(5, 9))),
                # A session in the query.
                lambda: f"{self.host()}.{suffix}/index.php{self.query(2, 5, 32)}",
                # An ordinary look.
                lambda: f"{self.host()}.{suffix}{self.page()}" if self.rng.random() < 0.4 else self.bad(suffix),
            )
        )()


def labelled_urls(per_suffix: int = PER_SUFFIX, seed: int = SEED) -> list[tuple[str, str]]:
    """``per_suffix`` URLs under each suffix, each with ``allow`` or ``block``."""
    make = _Maker(seed)
    rows = []
    for suffix, bad in BAD_OF_100.items():
        for k in range(per_suffix):
            scheme = make.rng.choice(("https", "http"))
            blocked = k * 100 < bad * per_suffix
            url = make.bad(suffix) if blocked else make.good(suffix)
            rows.append((f"{scheme}://{url}", "block" if blocked else "allow"))
    return rows


LABELLED = labelled_urls()
