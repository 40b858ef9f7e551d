"""Small datasets made by rule; tests compute their figures from the same rows."""

from tidemark import schemas

SHOPS = ["north", "south", "west"]
GOODS = ["tools", "garden", "music", "toys"]
KINDS = ["bridge", "forest", "harbour", "market", "tower", "valley"]

# Rating, time, source and product category.
EXISTING = [
    (str(i * 7 % 5 + 1), f"2024-03-{i + 1:02}T09:{i:02}:00", SHOPS[i // 2 % 3], GOODS[i % 4])
    for i in range(15)
]
SCRAPED = [
    (str(i * 3 % 5 + 1), f"2024-09-05T{i + 8:02}:00:00", "web_scraping", GOODS[i % 4])
    for i in range(5)
]

# Category, source and size in KB.
IMAGES = [(KINDS[i * i % 6], SHOPS[i % 3], str(100 + 37 * i)) for i in range(15)]
SCRAPED_IMAGES = [(KINDS[i], "web_scraping", str(250 + 11 * i)) for i in range(5)]

# Ten titles of three to seven words; some end in a mark, some in a link.
NEWS_WORDS = [[(KINDS + GOODS)[(3 * i + 7 * k) % 10] for k in range(3 + i % 5)] for i in range(10)]
NEWS = [
    (
        f"item-{i}",
        ", ".join(words).title() + ("!" if i % 2 else "") + (f" https://x.example/{i}" if i % 5 == 4 else ""),
        f"2024-05-{i + 2:02}T{2 * i:02}:30:00",
        SHOPS[i % 3],
    )
    for i, words in enumerate(NEWS_WORDS)
]
# Number of titles, mean and most words, number of sources.
NEWS_STATS = (10, 5.0, 7, 3)


def existing_reviews(spark):
    rows = [
        (str(i), f'Review {i}, with "quotes",\ncommas and a line break', *row)
        for i, row in enumerate(EXISTING, 1)
    ]
    return spark.createDataFrame(rows, schemas.REVIEWS_EXISTING)


def scraped_reviews(spark):
    rows = [
        (f"page-{i}", f"Scraped text {i}", *row, "site.example")
        for i, row in enumerate(SCRAPED, 1)
    ]
    return spark.createDataFrame(rows, schemas.REVIEWS_SCRAPED)


def existing_images(spark):
    rows = [
        (str(i), f"image_{i:03}.jpg", category, f"2025-01-{i + 14}T10:00:00", source, size,
         "1920", "1080", "jpg")
        for i, (category, source, size) in enumerate(IMAGES, 1)
    ]
    return spark.createDataFrame(rows, schemas.IMAGES_EXISTING)


def scraped_images(spark):
    rows = [
        (f"found-{i}", f"found-{i}.jpg", category, f"2025-06-24T{i + 7:02}:00:00",
         source, size, "site.example", f"https://site.example/{i}")
        for i, (category, source, size) in enumerate(SCRAPED_IMAGES, 1)
    ]
    return spark.createDataFrame(rows, schemas.IMAGES_SCRAPED)


def news(spark):
    return spark.createDataFrame(NEWS, schemas.NEWS)
