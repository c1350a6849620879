"""Schemas of the known inputs. Ids stay strings; counters are bigint."""

from pyspark.sql.types import (
    ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)


def _struct(spec: dict) -> StructType:
    return StructType([StructField(name, kind) for name, kind in spec.items()])


TEXT, COUNT, FLAG = StringType(), LongType(), BooleanType()

AUTHOR = _struct({
    "id": TEXT, "userName": TEXT, "name": TEXT, "followers": COUNT, "following": COUNT,
    "isVerified": FLAG, "isBlueVerified": FLAG, "location": TEXT, "createdAt": TEXT,
})

TWEET = _struct({
    "type": TEXT, "id": TEXT, "url": TEXT, "text": TEXT, "source": TEXT, "createdAt": TEXT,
    "lang": TEXT, "retweetCount": COUNT, "replyCount": COUNT, "likeCount": COUNT,
    "quoteCount": COUNT, "viewCount": COUNT, "isReply": FLAG, "conversationId": TEXT,
    "author": AUTHOR,
})

TWEETS_SNAPSHOT = _struct({
    "_id": TEXT, "date": TEXT, "tweets": ArrayType(TWEET), "has_next_page": FLAG,
    "next_cursor": TEXT, "createdAt": TEXT,
})

NEWS_ITEM = _struct({"newsLink": TEXT, "comments": ArrayType(TEXT), "_id": TEXT})

NEWS_SNAPSHOT = _struct({
    "_id": TEXT, "date": TEXT, "news": ArrayType(NEWS_ITEM), "createdAt": TEXT,
    "updatedAt": TEXT, "__v": IntegerType(),
})

SNAPSHOTS = {"twitter": TWEETS_SNAPSHOT, "webscraping": NEWS_SNAPSHOT}
