"""Small Bronze snapshots in the shape of the landed documents."""

from __future__ import annotations

import json

DAY_MS = {"2026-05-28": "1779926400000", "2026-05-29": "1780012800000", "2026-06-02": "1780358400000"}


def post(ident: str, text: str, likes: int, user: str, **more) -> dict:
    base = {
        "type": "tweet", "id": ident, "url": f"https://x.y/{ident}", "text": text, "source": "web",
        "createdAt": "Thu May 28 19:11:50 +0000 2026", "lang": "en", "retweetCount": 1, "replyCount": 2,
        "likeCount": likes, "quoteCount": 0, "viewCount": 10, "isReply": False, "conversationId": ident,
        "author": {"id": f"u{user}", "userName": user, "name": user.title(), "followers": 100 + likes,
                   "following": 5, "isVerified": False, "isBlueVerified": True, "location": None,
                   "createdAt": "Thu May 28 19:11:50 +0000 2020"}}
    return {**base, **more}


def tweets_snapshot(day: str, posts: list[dict], ident: str = "s1") -> dict:
    return {"_id": ident, "date": DAY_MS[day], "tweets": posts, "has_next_page": False,
            "next_cursor": "", "createdAt": f"{day}T10:00:00"}


def news_snapshot(day: str, articles: dict[str, list], ident: str = "n1") -> dict:
    return {"_id": ident, "date": DAY_MS[day], "createdAt": f"{day}T10:00:00", "updatedAt": f"{day}T10:00:00",
            "__v": 0, "news": [{"newsLink": link, "comments": comments, "_id": f"{ident}-{i}"}
                               for i, (link, comments) in enumerate(articles.items())]}


POSTS = [
    post("1", "I got the iPhone, great camera 😎 @me https://t.co/x", 10, "ann"),
    post("2", "Galaxy battery is bad, the worst <b>ever</b>", 4, "bob"),
    post("3", "Pixel photo is good", 7, "ann", lang="es"),
    post("4", "nothing to see", 0, "cyd"),
]
ARTICLES = {
    "https://n/1": ["Galaxy screen is awful and the price is terrible", "deleted", "nice"],
    "https://n/2": ["Apple makes excellent laptops, love the MacBook", "multi\nline comment about samsung"],
}


def land(folder, name: str, document) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(document, ensure_ascii=False), encoding="utf-8")
