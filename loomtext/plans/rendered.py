"""Wikitext pages rendered from the tables at hand, by expressions that Spark and an independent SQL engine both read.

The text is one expression per table, without backslashes or quote marks inside its literals, so that it means the
same everywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: (alias, expression) of the pages made from part.
PAGE = {
    "id": "cast(p_partkey as string)",
    "title": "concat(case when p_partkey % 5 = 0 then 'Category:' when p_partkey % 7 = 3 then 'template: ' else '' end, p_name, '_', cast(p_size as string))",
    "ns": "case when p_partkey % 11 = 4 then '10' when p_partkey % 13 = 5 then '828' else '0' end",
    "text": """concat(
        repeat(chr(39), 3), p_name, repeat(chr(39), 3), ' is a [[', p_type, ' (kind)|', lower(p_type), ' part]]s of [[', p_brand,
        ']], see [[File:', p_brand, '.png|thumb|cap]] and [[w:', p_name, ']].', chr(10),
        'Sold ', cast(p_size % 90 + 1 as string), ',', lpad(cast(p_partkey % 1000 as string), 3, '0'), ' and 12,', lpad(cast(p_size as string), 3, '0'),
        ' times;  called ', repeat(chr(39), 2), p_brand, repeat(chr(39), 2), ' or ', repeat(chr(39), 2), '"', p_name, '"', repeat(chr(39), 2), '.....', chr(10),
        'Price [http://shop.example/', cast(p_partkey as string), ' about ', cast(p_size as string), ' coins],, or [HTTPS://x.example/a?b=', cast(p_size as string), '] ,. __NOTOC__', chr(10),
        '{{Cat main|', p_name, '}} {{lc:', p_type, '}} {{infobox ', p_brand, '|size=', cast(p_size as string), '|name=', p_name, '}}', chr(10),
        '{| class=list', chr(10), '| ', p_name, chr(10), '|}', chr(10),
        '&lt;math&gt;x^', cast(p_size as string), '&lt;/math&gt; and &lt;math&gt;y&lt;/math&gt; &amp;amp; &lt;b&gt;bold&lt;/b&gt; &amp;lt;', chr(10),
        '[[Category:', p_brand, '|', p_name, ']] [[Category:', p_type, ']]')""",
    "sections": """concat(
        '== Size ', cast(p_size as string), ' ==', chr(10), case when p_size % 3 = 0 then concat('* first', chr(10), '# second', chr(10)) else '' end,
        case when p_size % 4 = 1 then ' ' else '' end, p_name, chr(10), ': ', p_type, chr(10), '=== Empty ===', chr(10),
        case when p_size % 5 = 2 then concat('* ', p_type, chr(10), ' after the list', chr(10)) else '' end, case when p_size % 2 = 0 then '{| rest' else '(aside)' end, chr(10), chr(10),
        '++Note++', chr(10), '---', chr(10), ' indented ', p_brand, chr(10), 'last ', p_type, '}', chr(10), 'end ', p_name)""",
    "marks": """concat(p_name, chr(10), ' ! ', chr(10), 'a', chr(9), 'b   c <<', p_brand, '>>,,', cast(p_size as string), ',.‧．__NOEDITSECTION__ __INDEX__',
        ' [[', p_type, '|', p_name, ']] [[x:', p_brand, ']] see.......')""",
    "template": """concat('&lt;!-- ', p_name, ' --&gt;', case when p_size % 3 = 0 then concat('&lt;onlyinclude&gt;', p_brand, '&lt;/onlyinclude&gt; rest') else p_type end,
        '&lt;noinclude&gt;', p_name, '&lt;/noinclude&gt;', case when p_size % 4 = 0 then '&lt;includeonly&gt;' else '' end, '{{{1|', p_name, '}}}')""",
    "entities": """concat('&#', cast(p_partkey % 900 + 33 as string), ';&#x', lower(hex(p_partkey % 700 + 8704)), ';&eacute;&Omega;&hearts;&nbsp;', p_name,
        '&amp;lt;&unknown;&#xzz;&#55296;&#1114112;&#99999999999999999999; & &; &euro;&#128512;')""",
    "wrapped": "concat('&lt;b&gt; ', p_name, ' &lt;syntaxhighlight lang=x&gt;a &amp;lt; ', p_brand, '&lt;/syntaxhighlight&gt; &quot;', p_type, '&quot;')",
    "lefts": """concat(p_name, chr(10), '{{lang|fr|', p_name, '}} b', chr(10), 'a {{lang|fr|', p_type, '}} b', chr(10), '{{IPA|', p_brand, '}}', chr(10),
        '{{lang-de|', p_type, '|x}}', chr(10), '{{link|a|', p_brand, '}}', chr(10), '{{zz|', p_brand, '}}', chr(10), 'end {x}')""",
    "nested": """concat('a<div class=x>', p_name, '<div>in</div> rest</div>b', chr(10), '{| t', chr(10), '{| ', p_name, ' |} u', chr(10), '|}c <small>gone</small>', p_brand,
        '<ref name=y>z</ref> <span id=q>', p_type, '</span><br/>')""",
    "lists": """concat('== ', p_name, ' ==', chr(10), '* ', p_type, chr(10), '** ', p_brand, chr(10), '# c', chr(10), 'after ', p_name, chr(10), '=== Deep! ===', chr(10), 'last ', p_type)""",
    "latin": "concat('版本', p_brand, ' ', cast(p_size as string), ' ', p_name, '　', p_type, ' 中 文 v2.', cast(p_size as string), ' b')",
}


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that pages are made from. They are few and stand in one small file, but the text function works a
    millisecond on each: they are dealt to all cores before they are rendered."""
    return spark.read.parquet(f"{sf_dir}/part.parquet").repartition(spark.sparkContext.defaultParallelism)


def pages(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return parts(spark, sf_dir).selectExpr(*[f"{PAGE[c]} AS {c}" for c in columns])


def pages_sql(*columns: str) -> str:
    return f"(SELECT {', '.join(f'{PAGE[c]} AS {c}' for c in columns)} FROM part)".replace("cast(p_partkey as string)", "cast(p_partkey as varchar)")
